"""Pattern and whitespace helpers shared by the text functions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace including the four separator controls, which Java's Unicode
# \s leaves out.
WHITESPACE = (
    " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# ASCII and Latin-1 members one by one land in a bit set; the rest sits behind one
# range test, so an ordinary character costs two checks.
SPACE = (
    r"[ \t\n\x0B\f\r\x1c\x1d\x1e\x1f\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)


def pattern(text: str, ignore_case: bool = False) -> str:
    """Java form of a Unicode-aware pattern whose line end is ``\\n`` alone."""
    flags = "(?idU)" if ignore_case else "(?dU)"
    return flags + text.replace(r"\s", SPACE)


def text(c: Column) -> Column:
    """NULL counts as the empty string."""
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace (plain ``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse(c: Column) -> Column:
    """Runs of whitespace become one blank; both ends are trimmed."""
    return strip(F.regexp_replace(c, f"{SPACE}+", " "))


def matches(c: Column, text: str, ignore_case: bool = False) -> Column:
    return c.rlike(pattern(text, ignore_case))


def remove(c: Column, text: str, ignore_case: bool = False) -> Column:
    return F.regexp_replace(c, pattern(text, ignore_case), "")


def _any(words: list[str]) -> str:
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def contains_any(c: Column, words: list[str]) -> Column:
    return c.rlike(_any(words))


def starts_with_any(c: Column, words: list[str]) -> Column:
    return c.rlike(rf"\A{_any(words)}")


def one_of(c: Column, words: list[str]) -> Column:
    return c.rlike(rf"\A{_any(words)}\z")


def like_any(c: Column, patterns: list[str]) -> Column:
    """``c LIKE '%p%'`` for any pattern, as one search."""

    def searched(p: str) -> str:
        out, quoted = "", False
        for ch in p:
            if quoted or ch not in "\\%_":
                out, quoted = out + re.escape(ch), False
            elif ch == "\\":
                quoted = True
            else:
                out += ".*" if ch == "%" else "."
        return out

    return c.rlike("(?s)" + "|".join(searched(p) for p in patterns))


def bind(c: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``c`` once and use it many times inside ``body``."""
    return F.element_at(F.transform(F.array(c), body), 1)
