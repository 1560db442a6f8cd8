"""Repair of conversation structure: the cheapest edits that make the turns alternate."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import col, fresh

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = [".", "!", "?"]
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
# What has been given so far: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
# Conversations of up to this many rows are remembered by their symbols, so many at a time.
SHORT, REMEMBERED = 24, 200_000
INFINITE = 1 << 60
OUT_ROWS = 4096


def turn_after(state: int) -> int:
    """The turn that may be added after ``state``, other than a system turn."""
    return ASSISTANT if state == USER else USER


def kept_state(state: int, symbol: str) -> int | None:
    """The state after the row is kept, if it may stand there."""
    initial = symbol.lower()
    if initial == "s" and state == START:
        return SYSTEM
    wanted = turn_after(state)
    return wanted if initial == ("a" if wanted == ASSISTANT else "u") else None


def lower_bounds(symbols: str) -> list[tuple[int, int, int, int]]:
    """Per place and state, a cost that no repair of the rest falls below.

    The costs are those of a simpler task, in which a system turn and an assistant turn
    count as one state, so that it may also end after a system turn.
    """
    costs = (0, 0, INSERT, 0)
    bounds = [costs]
    for symbol in reversed(symbols):
        extra = TRUNCATED if symbol.isupper() else 0
        before = [DELETE + costs[state] for state in range(4)]
        if symbol != "x":
            for state in range(4):
                after = kept_state(state, symbol)
                kept = INFINITE if after is None else extra + costs[after]
                before[state] = min(before[state], kept, REROLE + extra + costs[turn_after(state)])
        open_ = min(before[SYSTEM], before[ASSISTANT])
        user = min(before[USER], INSERT + open_)
        open_ = min(open_, INSERT + user)
        costs = (min(before[START], INSERT + user), open_, user, open_)
        bounds.append(costs)
    return bounds[::-1]


def cheapest_edits(symbols: str) -> tuple[int, str]:
    """The cost and the ASCII-least audit of the cheapest edits, by iterative-deepening A*.

    ``symbols`` has one character per row: the role's initial (``s``, ``u``, ``a``, or
    ``o`` for any other), upper case if the row is truncated, or ``x`` for a row that has
    to go.  The search goes depth first and tries delete, insert, keep and rerole in that
    order, which is ASCII order, under a bound on the cost so far plus the lower bound of
    the rest.  A state that failed with some budget is not entered again with as little.
    Bounds grow to the least cost that was cut off, so the first audit found is the answer.
    """
    n, rest = len(symbols), lower_bounds(symbols)
    bound = rest[0][START]
    while True:
        failed: dict[int, int] = {}
        over = INFINITE
        audit: list[str] = []
        # A frame is a place, a state, the cost so far and the moves left to try.
        stack = [(0, START, 0, iter(moves(symbols, 0, START)))]
        while stack:
            at, state, cost, left = stack[-1]
            if at == n and state in (START, ASSISTANT):
                return cost, "".join(audit)
            for letter, price, to, after in left:
                total = cost + price
                if total + rest[to][after] > bound:
                    over = min(over, total + rest[to][after])
                elif failed.get(4 * to + after, -1) < bound - total:
                    audit.append(letter)
                    stack.append((to, after, total, iter(moves(symbols, to, after))))
                    break
            else:
                failed[4 * at + state] = bound - cost
                stack.pop()
                if audit:
                    audit.pop()
        bound = over


def moves(symbols: str, at: int, state: int) -> list[tuple[str, int, int, int]]:
    """The edits possible at a place, in ASCII order: letter, cost, next place and state."""
    wanted = turn_after(state)
    if at == len(symbols):
        return [("I", INSERT, at, wanted)]
    symbol = symbols[at]
    found = [("D", DELETE, at + 1, state), ("I", INSERT, at, wanted)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        kept = kept_state(state, symbol)
        if kept is not None:
            found.append(("K", extra, at + 1, kept))
        found.append(("R", REROLE + extra, at + 1, wanted))
    return found


class Memory:
    """Answers for short conversations, most of which look alike."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, str]] = {}

    def edits(self, symbols: str) -> tuple[int, str]:
        if len(symbols) > SHORT:
            return cheapest_edits(symbols)
        if symbols not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known = {}
            self.known[symbols] = cheapest_edits(symbols)
        return self.known[symbols]


class Conversation:
    """What a task keeps of the conversation that is passing by: marks, never texts."""

    def __init__(self, name) -> None:
        self.name = name
        self.symbols: list[str] = []
        self.uids: list[int] = []
        self.seen: set[bytes] = set()
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.illegal = 0
        self.initial: str | None = None
        self.turns = [None, None, 0]

    def add(self, turn: int | None, uid: int, initial: str, fault: str, digest: bytes) -> None:
        if turn is not None:
            low, last, kinds = self.turns
            self.turns = [turn if low is None else low, turn, kinds + (turn != last)]
        if self.initial is not None:
            self.illegal += (self.initial, initial) not in LEGAL
        self.initial = initial
        if fault != "b" and digest in self.seen:
            fault = "d"
        self.seen.add(digest)
        if fault:
            self.counts[fault] += 1
        symbol = initial if initial in ("s", "u", "a") else "o"
        self.symbols.append("x" if fault in ("b", "d") else symbol.upper() if fault == "t" else symbol)
        self.uids.append(uid)

    def audit(self, memory: Memory) -> tuple:
        low, high, kinds = self.turns
        cost, letters = memory.edits("".join(self.symbols))
        gaps = 0 if low is None else high - low + 1 - kinds
        return gaps, self.counts["b"], self.counts["d"], self.counts["t"], self.illegal, cost, letters

    def lines(self, letters: str) -> Iterator[tuple[int, int | None, str | None]]:
        """The repaired conversation: place, the row to take (none if new), its new role (none if kept)."""
        place, at, state = 0, 0, START
        for letter in letters:
            if letter == "D":
                at += 1
                continue
            if letter == "K":
                state = kept_state(state, self.symbols[at])
            else:
                state = turn_after(state)
            yield place, None if letter == "I" else self.uids[at], None if letter == "K" else ROLES[state]
            at += letter != "I"
            place += 1


AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


@dataclass
class Repair:
    """``audits``: one row per conversation; ``repaired``: its rows in order of ``place``."""

    audits: DataFrame
    repaired: DataFrame


def ordered_marks(rows: DataFrame, names: list[str]) -> DataFrame:
    """Narrow rows ``conv, turn, uid, initial, fault, digest``, conversation by conversation."""
    conv, turn, role, text, uid = names
    body = F.rtrim(col(text), F.lit(BLANKS))
    fault = F.when(body == "", "b").when(~F.right(body, F.lit(1)).isin(ENDS), "t").otherwise("")
    digest = F.sha2(F.concat(F.length(col(role)).cast("string"), F.lit(":"), col(role), col(text)), 256)
    marks = rows.select(
        col(conv).alias("conv"), col(turn).cast("long").alias("turn"), col(uid).alias("uid"),
        F.left(col(role), F.lit(1)).alias("initial"), fault.alias("fault"),
        F.substring(F.unhex(digest), 1, 16).alias("digest"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "digest", "uid"]
    return marks.repartition("conv").sortWithinPartitions(*order)


def decisions(marks: DataFrame) -> DataFrame:
    """Per conversation a row with its audit, and a row per line of the repaired one."""
    kind = marks.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, {AUDIT}, place long, uid long, role string"

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, now, out = Memory(), None, []
        form = None

        def flush() -> pa.RecordBatch:
            cells = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, form)], schema=form)

        def close() -> Iterator[pa.RecordBatch]:
            audit = now.audit(memory)
            out.append((now.name, *audit, None, None, None))
            for line in now.lines(audit[-1]):
                out.append((now.name, *[None] * 7, *line))
                if len(out) >= OUT_ROWS:
                    yield flush()
                    out.clear()

        for batch in batches:
            if form is None:
                names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
                form = pa.schema(
                    [("conv", batch.schema.field("conv").type)] + [(n, pa.int64()) for n in names]
                    + [("audit", pa.string()), ("place", pa.int64()), ("uid", pa.int64()), ("role", pa.string())]
                )
            for name, *mark in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or name != now.name:
                    if now is not None:
                        yield from close()
                    now = Conversation(name)
                now.add(*mark)
        if now is not None:
            yield from close()
        if out:
            yield flush()

    return marks.mapInArrow(decide, schema)


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> Repair:
    """The cheapest repair of every conversation to ``(system? (user assistant)+)?``.

    A row's fault is the first of blank (no other characters than white space), duplicate
    (role and text came before in the conversation) and truncated (it does not end with
    ``.``, ``!`` or ``?``).  Edits: keep 0, rerole to user or assistant 1, delete 2, insert
    a turn without text 5; a truncated row that stays costs 5 more, blank and duplicate
    rows have to go.  Of equally cheap audits the ASCII-least is taken.

    Rows are ordered by turn, null turns first, rows of one turn by the digest of role and
    text; null roles and texts are one space; a null conversation is one of its own.
    Conversations without rows give no row; no rows give no rows.  Other columns are left out.

    Marks of some 60 bytes a row are sorted and searched, conversation by conversation, and
    texts meet the decisions by row number, so no task holds the texts of a conversation:
    one of a third of all rows costs its task marks for these.  The search enters a place in
    at most four states per bound.
    """
    (uid,) = fresh(rows, "uid")
    named = rows.select(
        col(conv_col), col(turn_col), *[F.coalesce(col(c), F.lit(" ")).alias(c) for c in (role_col, text_col)],
        F.monotonically_increasing_id().alias(uid),
    )
    # Numbers of rows hold once they are written.
    named = materialize(named)
    found = materialize(decisions(ordered_marks(named, [conv_col, turn_col, role_col, text_col, uid])))
    audits = found.filter("audit IS NOT NULL").drop("place", "uid", "role").withColumnRenamed("conv", conv_col)
    lines = found.filter("place IS NOT NULL").select("conv", "place", F.col("uid").alias("_uid"), "role")
    held = named.select(col(uid).alias("_held"), col(role_col).alias("_role"), col(text_col).alias("_text"))
    taken = lines.filter("_uid IS NOT NULL").join(held, F.col("_uid") == F.col("_held")).select(
        "conv", "place", F.coalesce("role", "_role").alias("role"), F.col("_text").alias("text")
    )
    new = lines.filter("_uid IS NULL").select("conv", "place", "role", F.lit("").alias("text"))
    repaired = taken.unionByName(new).withColumnsRenamed({"conv": conv_col, "role": role_col, "text": text_col})
    return Repair(audits, repaired)


def line_digests(
    repaired: DataFrame, conv_col: str = "conv_id", role_col: str = "role", text_col: str = "text",
    out: str = "repaired_sha256",
) -> DataFrame:
    """SHA-256 of each conversation's lines ``role:text``, joined by newlines, as they pass by."""
    kind = repaired.schema[conv_col].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            done = []
            for one, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is not None and one == name:
                    state.update(b"\n")
                else:
                    if state is not None:
                        done.append((name, state.hexdigest()))
                    name, state = one, hashlib.sha256()
                state.update(line.encode())
            kept = batch.schema.field(0).type
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d[0] for d in done], kept), pa.array([d[1] for d in done])], ["conv", out]
                )
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], kept), pa.array([state.hexdigest()])], ["conv", out])

    line = F.concat(col(role_col), F.lit(":"), col(text_col)).alias("line")
    dealt = repaired.select(col(conv_col).alias("conv"), "place", line).repartition("conv")
    dealt = dealt.sortWithinPartitions("conv", "place").select("conv", "line")
    return dealt.mapInArrow(digest, f"conv {kind}, `{out}` string").withColumnRenamed("conv", conv_col)


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Rows of ``conversations`` with faults planted by crc32 of ``conv_id:turn``, nulls as one space."""

    def plain(c: str) -> Column:
        return F.coalesce(col(c).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(plain(conv_col), F.lit(":"), plain(turn_col)).cast("binary")) % 20
    text = F.when(lot == 1, "").when(lot == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    times = F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = rows.filter(lot != 0).select(
        col(conv_col), col(turn_col), F.when(lot == 4, "user").otherwise(plain("role")).alias("role"),
        text.alias("text"), F.explode(times).alias("_copy"),
    )
    return kept.drop("_copy")
