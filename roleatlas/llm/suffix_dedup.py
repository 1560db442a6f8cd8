"""Removal of repeated byte strings by a distributed, prefix-aware merge sort of suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..operators.topk import global_rank
from ..session import materialize, sparse_join
from .common import col
from .suffix_runs import Run, merge_runs, pack_run, unpack_run
from .words import BASE, INVERSE, mix, powers, slices, text_bytes

LENGTH = 100
# Suffixes are taken where a string of GRAM bytes has the least hash of a window.
GRAM = 32
# Filters have 2**16 to 2**28 bits.
FILTER_BITS = 16, 28
HOT = 10_000
SIGNED_BYTES = 8 << 20
RUN_BYTES = 12 << 20
SLICE_BYTES = 1 << 20
PART_SUFFIXES = 40_000
# Merged suffixes are compared in batches of about so many, at bounds of groups.
GROUPS_AT_ONCE = 4000
INTERVALS = "key long, start long, end long"
SIGNATURES = "gram long, own long, pos long, span long, of long"
MAPPED = f"part int, run binary, hash long, gram long, pos long, {INTERVALS}"


def hash_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    return sums


def hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start])


def anchors(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int, sums: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """The windows of ``length`` bytes by their anchors: text, first and last start, anchor, hash.

    A window's anchor is the leftmost of its strings of ``gram`` bytes with the least
    hash, so equal windows have it at the same place, and windows next to each other
    mostly share it.
    """
    n, width = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    sizes = np.diff(offsets)
    long_ = np.flatnonzero(sizes >= length)
    if not len(long_):
        return none, none, none, none, none.astype(np.uint64)
    sums = hash_sums(data) if sums is None else sums
    m = n - gram + 1
    every = mix((sums[gram:] - sums[:m]) * powers(INVERSE, n + 1)[:m])
    bits = np.uint64(int(n).bit_length())
    least = (every >> bits << bits) | np.arange(m, dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[:len(least) - (width - step)], least[width - step:])
    counts = sizes[long_] - length + 1
    begin = np.cumsum(counts) - counts
    start = np.arange(counts.sum()) + np.repeat(offsets[:-1][long_] - begin, counts)
    at = (least[start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = at[1:] != at[:-1]
    new[begin] = True
    first = np.flatnonzero(new)
    low, high = start[first], start[np.append(first[1:], len(start)) - 1]
    text = np.searchsorted(offsets, low, "right") - 1
    return text, low, high, at[first], every[at[first]]


def signatures(docs: DataFrame, bits: int, length: int, gram: int) -> DataFrame:
    """All anchors by their gram and the hash of their context, ``of`` being equal ones of a slice.

    What a slice has twice itself is settled: rows without ``own`` are such intervals,
    dealt anyhow.  An interval ends ``length`` bytes after its last window begins.
    """

    def rows(*columns) -> pa.RecordBatch:
        cells = [pa.array(c.view(np.int64)) if isinstance(c, np.ndarray) else c for c in columns]
        return pa.RecordBatch.from_arrays(cells, ["gram", "own", "pos", "span", "of"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(whole.column(1), SIGNED_BYTES):
                held, batch = [], whole.slice(a, b - a)
                for x, y in slices(batch.column(1), SLICE_BYTES):
                    keys = batch.column(0).slice(x, y - x).to_numpy(zero_copy_only=False)
                    data, offsets = text_bytes(batch.column(1).slice(x, y - x))
                    sums = hash_sums(data)
                    text, low, high, at, grams = anchors(data, offsets, length, gram, sums)
                    own = context_hashes(sums, low, high + length, at - low)
                    held.append((grams, own, (keys[text] << bits) + low - offsets[text], high - low))
                grams, own, pos, span = map(np.concatenate, zip(*held))
                first, of, rest = firsts((own, grams), pos)
                yield rows(grams[first], own[first], pos[first], span[first], of)
                start, end = join_intervals(pos[rest], pos[rest] + span[rest] + length)
                none = pa.nulls(len(start), pa.int64())
                yield rows(mix(start.astype(np.uint64)), none, start, end - start - length, np.zeros(len(start), np.int64))

    return docs.select("key", "text").mapInArrow(apply, SIGNATURES)


def met_contexts(docs: DataFrame, bits: int, length: int, gram: int) -> tuple[DataFrame, int]:
    """Where anchors meet others of their gram, by signatures alone, and the number of these anchors.

    Of equal contexts all but the first are settled: rows without ``contexts``.  The
    firsts are left where a gram has several ``contexts``, which only their texts decide.
    """
    by_context, by_gram = Window.partitionBy("gram", "own").orderBy("pos"), Window.partitionBy("gram")
    least = F.col("own").isNotNull() & (F.row_number().over(by_context) == 1)
    marked = signatures(docs, bits, length, gram).repartition("gram").withColumn("first", least)
    marked = marked.select(
        "gram", "pos", "span", "of", "first", F.count_if("first").over(by_gram).alias("contexts"),
        F.sum("of").over(by_gram).alias("total"),
    )
    seen = Observation()
    marked = marked.observe(seen, F.sum(F.when(F.col("total") > 1, F.col("of")).otherwise(0)).alias("n"))
    several = F.col("first") & (F.col("contexts") > 1)
    met = materialize(marked.filter(several | ~F.col("first")).select(
        F.when(several, F.col("gram")).alias("gram"), "pos", "span",
        F.when(several, F.col("contexts")).alias("contexts"),
    ))
    return met, seen.get["n"] or 0


def context_filters(met: DataFrame, hot: int) -> np.ndarray:
    """Filters as rows of bits: grams of several contexts, places of these, grams of more than ``hot``.

    They grow with the contexts up to 2**FILTER_BITS[1] bits each.  A set bit too many
    costs work and changes no result.
    """
    left = met.filter("contexts IS NOT NULL")
    wanted = (16 * left.count()).bit_length()
    bits = min(max(wanted, FILTER_BITS[0]), FILTER_BITS[1])

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, pos, contexts = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            grams = grams.view(np.uint64)
            for k, hash_ in enumerate((grams, mix(pos.astype(np.uint64)), grams[contexts > hot])):
                bucket = np.unique(hash_ >> np.uint64(64 - bits))
                word, first = np.unique(bucket >> np.uint64(6), return_index=True)
                set_ = np.uint64(1) << (bucket & np.uint64(63))
                set_ = np.bitwise_or.reduceat(set_, first) if len(first) else set_
                word = (word + np.uint64(k << (bits - 6))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(set_.view(np.int64))], ["word", "bits"])

    words = left.select("gram", "pos", "contexts").mapInArrow(set_bits, "word int, bits long")
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # 3 * 2**22 rows at most
    filters = np.zeros(3 << (bits - 6), np.int64)
    filters[words["word"].to_numpy()] = words["bits"].to_numpy()
    return filters.view(np.uint64).reshape(3, -1)


def has_bit(filter_: np.ndarray, hash_: np.ndarray) -> np.ndarray:
    bucket = hash_ >> np.uint64(64 - 6 - (len(filter_).bit_length() - 1))
    return (filter_[(bucket >> np.uint64(6)).astype(np.int64)] >> (bucket & np.uint64(63))) & np.uint64(1) > 0


def firsts(order_key: tuple[np.ndarray, ...], pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows with the least ``pos`` among those of equal keys, how many these are, and the rest."""
    order = np.lexsort((pos, *order_key))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in order_key:
        new[1:] |= key[order][1:] != key[order][:-1]
    return order[new], np.diff(np.append(np.flatnonzero(new), len(order))), order[~new]


def first_of(order_key: tuple[np.ndarray, ...], pos: np.ndarray) -> np.ndarray:
    """Mask of the rows with the least ``pos`` among those of equal keys."""
    out = np.zeros(len(pos), bool)
    out[firsts(order_key, pos)[0]] = True
    return out


def context_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, left: np.ndarray) -> np.ndarray:
    return hashes(sums, start, end) ^ mix(left.astype(np.uint64) + np.uint64(1))


class Contexts:
    """Anchors with the text that their windows cover, laid end to end."""

    def __init__(self, data: bytes, left: np.ndarray, span: np.ndarray, pos: np.ndarray, length: int) -> None:
        self.data, self.left, self.span, self.pos, self.length = data, left, span, pos, length
        self.size = span + length
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size

    def hashes(self) -> np.ndarray:
        sums = hash_sums(np.frombuffer(self.data, np.uint8))
        return context_hashes(sums, self.start, self.end, self.left)

    def some(self, at: np.ndarray) -> Contexts:
        data = b"".join([self.data[a:b] for a, b in zip(self.start[at].tolist(), self.end[at].tolist())])
        return Contexts(data, self.left[at], self.span[at], self.pos[at], self.length)

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all windows of the contexts ``at``: whose, hash, position."""
        sums = hash_sums(np.frombuffer(self.data, np.uint8))
        counts = self.span[at] + 1
        begin = np.cumsum(counts) - counts
        inside = np.arange(counts.sum()) - np.repeat(begin, counts)
        whose = np.repeat(at, counts)
        start = self.start[whose] + inside
        return whose, hashes(sums, start, start + self.length), self.pos[whose] + inside

    def repeats(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end positions of what occurs earlier among contexts of the same ``group``."""
        first = first_of((self.hashes(), group), self.pos)
        rest = np.flatnonzero(~first)
        kept = np.flatnonzero(first)
        _, which, count = np.unique(group[kept], return_inverse=True, return_counts=True)
        whose, hash_, pos = self.windows(kept[count[which] > 1])
        again = pos[~first_of((hash_, group[whose]), pos)]
        return (
            np.append(self.pos[rest], again),
            np.append(self.pos[rest] + self.size[rest], again + self.length),
        )


def join_intervals(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals; those that touch become one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1]


def interval_cells(start: np.ndarray, end: np.ndarray, bits: int) -> list[pa.Array]:
    """Positions as key and offsets; a text is shorter than its keys are apart, so none reaches the next."""
    low = (1 << bits) - 1
    return [pa.array(start >> bits), pa.array(start & low), pa.array((start & low) + end - start)]


def mapped_rows(
    docs: DataFrame, filters: np.ndarray, parts: int, bits: int, length: int, gram: int
) -> DataFrame:
    """The contexts that the filters let through: parts of runs, and of the hot grams windows.

    What a task has twice itself among the windows of hot grams is settled: intervals.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        data = b"".join(h[0] for h in held)
        grams, left, span, pos, hot = (np.concatenate([h[k] for h in held]) for k in range(1, 6))
        all_ = Contexts(data, left, span, pos, length)
        yield from packed(data, all_, grams, np.flatnonzero(~hot))
        hot_at = np.flatnonzero(hot)
        hot_ones = all_.some(hot_at)
        whose, hash_, at = hot_ones.windows(np.arange(len(hot_at)))
        whose = hot_at[whose]
        one = first_of((hash_, grams[whose]), at)
        start, end = join_intervals(at[~one], at[~one] + length)
        yield rows(len(start), **dict(zip(("key", "start", "end"), interval_cells(start, end, bits))))
        for k in range(0, int(one.sum()), 100_000):
            some = np.flatnonzero(one)[k:k + 100_000]
            cells = {"hash": hash_[some].view(np.int64), "gram": grams[whose[some]].view(np.int64), "pos": at[some]}
            yield rows(len(some), **cells)

    def packed(data: bytes, all_: Contexts, grams: np.ndarray, ours: np.ndarray) -> Iterator[pa.RecordBatch]:
        pos, span = all_.pos, all_.span
        begins, ends, lefts = all_.start.tolist(), all_.end.tolist(), all_.left.tolist()
        part = (grams % np.uint64(parts)).astype(np.int64)
        order = ours[np.argsort(part[ours], kind="stable")]
        # Groups of one part, in order of the parts.
        first = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1])) if len(order) else order
        for some in np.split(order, first[1:]) if len(order) else []:
            p = int(part[some[0]])
            some = sorted((data[begins[i] + lefts[i]:ends[i]], i) for i in some.tolist())
            mine = np.array([i for _, i in some])
            before = [data[begins[i]:begins[i] + lefts[i]] for _, i in some]
            yield rows(1, part=[p], run=[pack_run([s for s, _ in some], before, pos[mine], span[mine])])

    def rows(n: int, **cells) -> pa.RecordBatch:
        kinds = {"part": pa.int32(), "run": pa.binary()} | dict.fromkeys(
            ("hash", "gram", "pos", "key", "start", "end"), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(cells[c], k) if c in cells else pa.nulls(n, k) for c, k in kinds.items()], list(kinds))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several, places, often = shared.value
        held: list[tuple] = []
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                keys = batch.column(0).slice(a, b - a).to_numpy(zero_copy_only=False)
                data, offsets = text_bytes(batch.column(1).slice(a, b - a))
                text, low, high, at, grams = anchors(data, offsets, length, gram)
                pos = (keys[text] << bits) + low - offsets[text]
                some = np.flatnonzero(has_bit(several, grams) & has_bit(places, mix(pos.astype(np.uint64))))
                low, high, at, grams, pos = low[some], high[some], at[some], grams[some], pos[some]
                size = high - low + length
                begin = np.cumsum(size) - size
                flat = np.arange(size.sum()) + np.repeat(low - begin, size)
                held.append((data[flat].tobytes(), grams, at - low, high - low, pos, has_bit(often, grams)))
                if sum(len(h[0]) for h in held) > RUN_BYTES:
                    yield from flush(held)
                    held = []
        yield from flush(held)

    return docs.select("key", "text").mapInArrow(apply, MAPPED)


def merged_repeats(runs: list[Run], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """What occurs earlier among the suffixes of all runs of a part.

    The merge puts suffixes in order and says what neighbours share; those that share
    ``gram`` bytes have the same anchor string and are compared window by window.
    """
    starts, ends = [], []
    held: list[tuple[int, int, int]] = []
    number = -1
    for r, i, shared in merge_runs(runs):
        number += shared < gram
        if shared < gram and len(held) > GROUPS_AT_ONCE:
            start, end = held_repeats(runs, held, length)
            starts.append(start)
            ends.append(end)
            held = []
        held.append((r, i, number))
    start, end = held_repeats(runs, held, length)
    return np.concatenate([*starts, start]), np.concatenate([*ends, end])


def held_repeats(runs: list[Run], held: list[tuple[int, int, int]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """What occurs earlier among whole groups of merged suffixes (run, index, group)."""
    if not held:
        none = np.zeros(0, np.int64)
        return none, none
    data = b"".join([part for r, i, _ in held for part in (runs[r].left[i], runs[r].suffix[i])])
    left = np.array([len(runs[r].left[i]) for r, i, _ in held], np.int64)
    pos = np.array([runs[r].pos[i] for r, i, _ in held], np.int64)
    span = np.array([runs[r].span[i] for r, i, _ in held], np.int64)
    group = np.array([g for *_, g in held], np.int64)
    return Contexts(data, left, span, pos, length).repeats(group)


def keyed_documents(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``id, key, text`` with keys in the order of the ids, and the bits that offsets need.

    Distinct ids that leave room for the offsets are their own keys; else (null,
    repeated or very distant ids) rows are ranked by id and a hash of the text.
    """
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count("id").alias("ids"), F.min("id").alias("low"),
        F.max("id").alias("high"), F.coalesce(F.max(F.octet_length("text")), F.lit(0)).alias("longest"),
    ).first()
    bits = max(int(facts["longest"]).bit_length(), 8) + 1
    plain = isinstance(facts["low"], int) and facts["ids"] == facts["n"]
    plain = plain and (facts["high"] - facts["low"]).bit_length() + bits <= 62
    if plain and rows.groupBy("id").count().filter("count > 1").isEmpty():
        low = facts["low"]
        return rows.select("id", (F.col("id").cast("long") - F.lit(low)).alias("key"), "text"), bits
    marked = rows.withColumn("mark", F.sha2("text", 256))
    ranked = global_rank(marked.select("id", "mark").distinct(), [F.col("id").asc_nulls_first(), F.col("mark")], "key")
    ranked = ranked.select(F.col("id").alias("own"), F.col("mark").alias("own_mark"), "key")
    keyed = marked.join(ranked, F.col("id").eqNullSafe(F.col("own")) & (F.col("mark") == F.col("own_mark")))
    return materialize(keyed.select("id", "key", "text")), bits


def repeated_intervals(keyed: DataFrame, bits: int, length: int, gram: int, hot: int) -> DataFrame:
    """``key, start, end`` of byte ranges whose strings of ``length`` bytes start earlier somewhere."""
    met, suffixes = met_contexts(keyed, bits, length, gram)
    parts = max(1, suffixes // PART_SUFFIXES)
    mapped = materialize(mapped_rows(keyed, context_filters(met, hot), parts, bits, length, gram))

    def merge(group: pa.Table) -> pa.Table:
        runs = [unpack_run(blob) for blob in group["run"].to_pylist()]
        start, end = join_intervals(*merged_repeats(runs, length, gram))
        return pa.table(dict(zip(("key", "start", "end"), interval_cells(start, end, bits))))

    merged = mapped.filter("part IS NOT NULL").select("part", "run").groupBy("part").applyInArrow(merge, INTERVALS)
    windows = mapped.filter("pos IS NOT NULL").select("hash", "gram", "pos")
    first = windows.groupBy("hash", "gram").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    later = windows.join(first.filter("n > 1"), ["hash", "gram"]).filter("pos <> first")
    later = later.select("pos", F.lit(0).cast("long").alias("span"))
    later = later.unionAll(met.filter("contexts IS NULL").select("pos", "span"))
    offset = F.expr(f"pos & {(1 << bits) - 1}L")
    later = later.select(
        F.shiftright("pos", bits).alias("key"), offset.alias("start"), (offset + F.col("span") + length).alias("end")
    )
    return mapped.filter("key IS NOT NULL").select("key", "start", "end").unionAll(merged).unionAll(later)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
    gram: int | None = None, hot: int = HOT,
) -> DataFrame:
    """The id, ``n_bytes``, ``spans`` (removed ranges) and ``kept`` (bytes left) of each text.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in
    a text of smaller id, or sooner in the same one.  Strings are judged on the input.

    Only suffixes at anchors take part (a window's least hash of ``gram`` bytes, so a
    few in a hundred).  First their signatures meet by the anchor string: of equal
    contexts only the first goes on, and only where the string has several.  These
    contexts alone move as text: each task sorts them by suffix and hands them on as
    front-coded runs by the hash of the anchor string; a loser tree merges the runs of
    a part, comparing each byte of a prefix once.  Anchor strings of more than ``hot``
    contexts are exchanged by the hash of the window instead, so a passage that a
    third of all texts have is no group, and neither are its many surroundings.  At the
    end only texts that lose something are shuffled.

    Nulls: a null text is empty; a null id comes before all others.  Rows that repeat an
    id and text count as one row and are cut alike; other texts under a repeated id
    are ordered by a hash.  Texts shorter than ``length`` stay whole.  No rows give no rows.
    """
    gram = gram or min(GRAM, max(1, length // 2))
    keyed, bits = keyed_documents(docs, id_col, text_col)
    found = repeated_intervals(keyed, bits, length, gram, hot)
    listed = found.groupBy("key").agg(F.collect_list("start").alias("begins"), F.collect_list("end").alias("ends"))
    joined = sparse_join(keyed, listed, "key").select("id", "text", "begins", "ends")
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(whole.column(1)):
                batch = whole.slice(a, b - a)
                sizes, spans, kept = [], [], []
                for text, begins, ends in zip(batch.column(1), batch.column(2), batch.column(3)):
                    data = text.as_py().encode()
                    sizes.append(len(data))
                    start, end = (np.array(x.values if x.is_valid else [], np.int64) for x in (begins, ends))
                    start, end = join_intervals(start, end)
                    spans.append([{"start": x, "end": y} for x, y in zip(start.tolist(), end.tolist())])
                    edges = [0, *np.column_stack([start, end]).ravel().tolist(), len(data)]
                    kept.append(b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2])))
                range_ = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                cells = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, range_), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, [id_col, "n_bytes", "spans", "kept"])

    made = f"`{id_col}` {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return joined.mapInArrow(cut, made)
