"""Conversation repair against an exhaustive search over whole audits."""

import hashlib
import itertools
import re
import zlib

import pytest

from roleatlas.llm.catalog import registry
from roleatlas.llm.conversations import cheapest_edits, damaged, line_digests, repair_conversations

PATTERN = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def given(symbols, audit):
    """What an audit gives: initials and cost, or None where an edit is not allowed."""
    out, cost, at = "", 0, 0
    for letter in audit:
        wanted = "a" if out.endswith("u") else "u"
        if letter == "I":
            out, cost = out + wanted, cost + 5
            continue
        if at == len(symbols):
            return None
        symbol, at = symbols[at], at + 1
        if letter == "D":
            cost += 2
        elif symbol == "x":
            return None
        else:
            cost += 5 * symbol.isupper() + (letter == "R")
            out += wanted if letter == "R" else symbol.lower()
    return (out, cost) if at == len(symbols) else None


def brute(symbols):
    """All audits of up to two inserts more than rows, by cost and then by letters."""
    best = None
    for n in range(len(symbols), len(symbols) + 3):
        for letters in itertools.product("DIKR", repeat=n):
            found = given(symbols, letters)
            if found and PATTERN.fullmatch(found[0]):
                one = found[1], "".join(letters)
                best = one if best is None else min(best, one)
    return best


def test_every_short_conversation():
    for n in range(4):
        for symbols in itertools.product("suaoxUA", repeat=n):
            assert cheapest_edits("".join(symbols)) == brute("".join(symbols)), symbols


@pytest.mark.parametrize("symbols", ["suaua", "uuaax", "oUAua", "aaaaa", "sSuxa", "AUAUA", "xxxxx"])
def test_five_rows(symbols):
    assert cheapest_edits(symbols) == brute(symbols)


def test_long_conversation():
    cost, audit = cheapest_edits("ua" * 20_000 + "u" + "au" * 20_000)
    assert (cost, len(audit)) == (2, 80_001) and audit.count("D") == 1


def reference(rows, ids, damage=True):
    """The contract read plainly, one conversation at a time."""

    def plain(v):
        return " " if v is None else str(v)

    kept = []
    for conv, turn, role, text in rows:
        role, text, times = plain(role), plain(text), 1
        lot = zlib.crc32(f"{plain(conv)}:{plain(turn)}".encode()) % 20 if damage else 9
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        role, times = "user" if lot == 4 else role, 2 if lot == 3 else 1
        kept += [(conv, turn, role, text)] * (0 if lot == 0 else times)
    out = {}
    for conv in ids:
        # Rows of one turn follow their digests.
        mine = sorted(
            (r for r in kept if r[0] == conv),
            key=lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()),
        )
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, symbols, faults = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, _, role, text in mine:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault in ("b", "d") else letter.upper() if fault == "t" else letter
        illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(mine, mine[1:]))
        cost, audit = cheapest_edits(symbols)
        lines, at, last = [], 0, ""
        for letter in audit:
            if letter != "D":
                wanted = "assistant" if last == "u" else "user"
                role, text = (wanted, "") if letter == "I" else mine[at][2:]
                role = wanted if letter == "R" else role
                lines.append(f"{role}:{text}")
                last = role[:1]
            at += letter != "I"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit, digest)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = registry.queries["op13_conversation_repair"](spark, sf).collect()
    wanted = reference(rows, {r[0] for r in rows})
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got} == wanted


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, uid int, place int, _Copy int"
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."),
        (2, None, "user", "A?"), (2, 5, "user", "B"), (2, 9, None, "C."), (2, 9, "", "D. \n"),
        (None, 0, "user", "Who?"), (None, 1, "assistant", None), (3, 0, "tool", "\t\n"),
        (4, 0, "user", "x" * 300_000 + "."), (4, 1, "assistant", "É!"), (5, 7, "system", "Only."),
    ]
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema)
    for make, damage in ((lambda t: t, False), (damaged, True)):
        found = repair_conversations(make(table))
        digests = {r["conv_id"]: r["repaired_sha256"] for r in line_digests(found.repaired).collect()}
        empty = hashlib.sha256(b"").hexdigest()
        got = {
            r["conv_id"]: (*[r[c] for c in COLUMNS[:-1]], digests.get(r["conv_id"], empty))
            for r in found.audits.collect()
        }
        wanted = reference(rows, {r[0] for r in rows}, damage)
        nothing = (0, 0, 0, 0, 0, 0, "", empty)
        assert {k: got.get(k, nothing) for k in wanted} == wanted


def test_empty(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = repair_conversations(damaged(table))
    assert not found.audits.collect() and not line_digests(found.repaired).collect()


def test_one_conversation_holds_all(spark):
    rows = [(7, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(20_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = repair_conversations(table)
    (audit,) = found.audits.collect()
    assert audit["cost"] == 0 and audit["audit"] == "K" * 20_000
    lines = "\n".join(f"{r[2]}:{r[3]}" for r in rows)
    assert line_digests(found.repaired).first()["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
