"""Description, location and payload text as Column expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .regex import (
    bind, collapse, contains_any, matches, one_of, pattern, starts_with_any, strip, text,
)


def scrub_nul(c: Column) -> Column:
    """Drop NUL characters."""
    return F.translate(c, "\u0000", "")


def strip_html(c: Column) -> Column:
    """Tags become blanks, whitespace collapses."""
    return collapse(F.regexp_replace(c, fv.TAG_PATTERN, " "))


def clean_description(c: Column) -> Column:
    """B2: decode six entities in order, blank out the rest and all tags."""
    d = c
    for entity, plain in fv.LITERAL_ENTITIES:
        d = F.replace(d, F.lit(entity), F.lit(plain))
    d = F.regexp_replace(d, pattern(fv.NUMERIC_ENTITY_PATTERN), " ")
    d = F.regexp_replace(d, pattern(fv.NAMED_ENTITY_PATTERN), " ")
    # Most texts hold no entity at all; a byte search is cheaper than the passes.
    return strip_html(F.when(c.contains("&"), d).otherwise(c))


def is_garbage_description(c: Column) -> Column:
    """Too short, site navigation, a login wall or a script notice."""
    raw = text(c)

    def rules(d: Column) -> Column:
        navigation = F.lit(True)
        for phrase in fv.NAVIGATION_PHRASES:
            navigation = navigation & d.contains(phrase)
        notice = (F.length(d) < fv.SCRIPT_NOTICE_MAX_LENGTH) & contains_any(
            F.lower(d), fv.SCRIPT_NOTICES
        )
        return navigation | starts_with_any(d, fv.WALL_STARTS) | notice

    return F.when(F.length(raw) < fv.MIN_DESCRIPTION_LENGTH, True).otherwise(
        bind(strip(raw), rules)
    )


def clean_location(c: Column) -> Column:
    """Placeholder locations become the empty string."""

    def kept(loc: Column) -> Column:
        placeholder = matches(loc, fv.LOCATION_COUNT_PATTERN, ignore_case=True) | one_of(
            F.lower(loc), fv.LOCATION_PLACEHOLDERS
        )
        return F.when(placeholder, "").otherwise(loc)

    return bind(strip(c), kept)


def extract_role_text(c: Column, max_chars: int = fv.ROLE_TEXT_MAX_CHARS) -> Column:
    """The slice of a description that speaks of the role."""

    def slice_of(clean: Column) -> Column:
        size = F.length(clean)
        half = F.floor(size / 2).cast("int")
        # Only a header that starts in the first half counts.  The pattern repeats
        # nothing, so no header is longer than the pattern itself.
        window = F.substring(clean, F.lit(1), half + len(fv.ROLE_SECTION_PATTERN))
        # Length in characters of what precedes the first header; the whole window
        # when there is none, which fails the "first half" test.
        before = F.length(
            F.element_at(F.split(window, pattern(fv.ROLE_SECTION_PATTERN, True), 2), 1)
        )
        lead, body = fv.ROLE_TEXT_LEAD_CHARS, fv.ROLE_TEXT_BODY_START
        two_windows = F.concat(
            F.substring(clean, 1, lead), F.lit(" "),
            F.substring(clean, body + 1, max_chars - lead),
        )
        headed = before < half
        return (
            F.when(size <= max_chars, clean)
            .when(headed, F.substring(clean, before + 1, F.lit(max_chars)))
            .when(size > fv.ROLE_TEXT_LONG, two_windows)
            .otherwise(F.substring(clean, 1, max_chars))
        )

    return bind(strip_html(c), slice_of)


def role_text(title: Column, description: Column) -> Column:
    """What the embedder reads: title, then the role slice."""
    t, d = strip(text(title)), strip(text(description))
    return F.when(d == "", t).otherwise(F.concat(t, F.lit(". "), extract_role_text(d)))


def text_long_enough(c: Column) -> Column:
    """C7."""
    return F.length(strip(c)) > fv.MIN_ENCODED_TEXT


def embed_input(c: Column) -> Column:
    """Blank or tiny inputs are replaced by a neutral phrase."""
    return F.when(F.length(strip(c)) > fv.MIN_EMBED_INPUT, c).otherwise(fv.EMBED_PLACEHOLDER)


# A reference as HTML writes it: the closing semicolon may be missing.
_REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
_REPLACEMENT = "\ufffd"


def _by_letter(names: dict[str, str]) -> Column:
    """A constant map of maps: the names that begin with a letter."""
    out: dict[str, dict[str, str]] = {}
    for name, value in names.items():
        out.setdefault(name[0], {})[name] = value
    return F.from_json(F.lit(json.dumps(out)), "map<string,map<string,string>>")


def _windows_1252(code: int) -> str:
    """What browsers take a reference to 128-159 for."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def unescape_html(c: Column) -> Column:
    """Decode all character references of HTML 5 in one pass: ``&amp;lt;`` gives ``&lt;``.

    Numbers have any count of digits; null, surrogates and what is beyond Unicode give
    U+FFFD, 128-159 are read as Windows-1252, other control and non-characters vanish.
    The names of HTML 4 need no semicolon and may run on into letters.  Unknown
    references stay as they are.
    """
    named = _by_letter({n[:-1]: v for n, v in html5.items() if n.endswith(";")})
    legacy_names = {n: v for n, v in html5.items() if not n.endswith(";")}
    legacy = _by_letter(legacy_names)
    controls = F.array(*[F.lit(_windows_1252(b)) for b in range(128, 160)])

    def character(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def lookup(table: Column, name: Column) -> Column:
        return F.element_at(F.element_at(table, F.substring(name, 1, 1)), name)

    def number(ref: Column) -> Column:
        digits = F.regexp_replace(ref, "^#[xX]?0*|;$", "")
        base = F.when(ref.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
        code = F.when(F.length(digits) > 7, 0x110000).when(digits == "", 0).otherwise(base.cast("long"))

        def value(n: Column) -> Column:
            nothing = (
                (n < 9) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF)
                | (n.bitwiseAND(0xFFFE) == 0xFFFE)
            )
            return (
                F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), _REPLACEMENT)
                .when(n.between(128, 159), F.get(controls, (n - 128).cast("int")))
                # The decoder takes this one for a byte order mark.
                .when(n == 0xFEFF, "\ufeff").when(nothing, "").otherwise(character(n))
            )

        return bind(code, value)

    def name(ref: Column) -> Column:
        exact = F.when(ref.endswith(";"), lookup(named, F.regexp_replace(ref, ";$", "")))
        longest, least = max(map(len, legacy_names)), min(map(len, legacy_names))
        beginnings = [
            F.concat(lookup(legacy, F.substring(ref, 1, n)), F.substring(ref, F.lit(n + 1), F.length(ref)))
            for n in range(longest, least - 1, -1)
        ]
        return F.coalesce(exact, *beginnings, F.concat(F.lit("&"), ref))

    references = F.transform(
        F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(1)),
        lambda ref: F.when(ref.startswith("#"), number(ref)).otherwise(name(ref)),
    )
    woven = F.zip_with(F.split(c, _REFERENCE), references, lambda a, b: F.concat(a, text(b)))
    return F.when(c.contains("&"), F.array_join(woven, "")).otherwise(c)


def html_text(c: Column) -> Column:
    """Trimmed non-empty text nodes of an HTML fragment, one per line."""
    visible = F.regexp_replace(
        c, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "<br>"
    )
    nodes = F.transform(F.split(visible, "<[/!?]?[A-Za-z][^>]*>"), lambda n: strip(unescape_html(n)))
    return F.array_join(F.filter(nodes, lambda n: n != ""), "\n")


def flatten_sections(lists: Column) -> Column:
    """Per section its heading, then ``- item`` per list item, newline-joined."""

    def section(s: Column) -> Column:
        items = F.transform(
            F.split(text(s["content"]), "<li>"),
            lambda i: strip(F.replace(i, F.lit("</li>"), F.lit(""))),
        )
        bullets = F.transform(
            F.filter(items, lambda i: i != ""), lambda i: F.concat(F.lit("- "), i)
        )
        return F.concat(F.array(text(s["text"])), bullets)

    return F.coalesce(F.array_join(F.flatten(F.transform(lists, section)), "\n"), F.lit(""))


def lever_remote(workplace: Column) -> Column:
    """B13, lever: only the two known kinds are kept."""
    return F.when(workplace.isin(fv.LEVER_WORKPLACES), workplace).otherwise("")


def ashby_remote(is_remote: Column, workplace: Column) -> Column:
    """B13, ashby: the flag wins over the workplace type."""
    flag = F.coalesce(is_remote, F.lit(False))
    return F.when(flag, "remote").otherwise(F.lower(text(workplace)))


def posted_date(c: Column) -> Column:
    """The first ten characters, whatever they are."""
    return F.substring(text(c.cast("string")), 1, 10)


def posted_on(c: Column) -> Column:
    """B14, typed: a DATE when the text starts like one, else NULL."""
    return F.when(
        c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")
    )
