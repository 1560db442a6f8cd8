"""Best-two-fit packing of token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import col
from .tokens import encoder
from .words import slices

CAPACITY = 2048
TEXT_BYTES = 8 << 20


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Texts as pieces of at most ``capacity`` ids, each text's ids followed by one id 0.

    Columns: the id, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``,
    little-endian unsigned 32-bit, on request), and for the packing ``chunk``, the
    task that made the piece, and ``place``, its number among the task's pieces of
    that length.
    """
    made = "piece int, start long, length long, ids_crc32 long, chunk int, place long"
    made += ", ids binary" if with_ids else ""
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chunk = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for at, to in slices(whole.column(1), TEXT_BYTES):
                batch = whole.slice(at, to - at)
                ids, begins = own.encode(batch.column(1))
                rows, parts = [], []
                for i in range(batch.num_rows):
                    data = ids[begins[i]:begins[i + 1]].tobytes() + b"\0\0\0\0"
                    for k, begin in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[begin:begin + 4 * capacity]
                        n = len(part) // 4
                        rows.append((i, k, begin // 4, n, zlib.crc32(part), chunk, int(seen[n])))
                        seen[n] += 1
                        if with_ids:
                            parts.append(part)
                at_doc, *cells = map(np.array, zip(*rows))
                out = [batch.column(0).take(pa.array(at_doc))]
                out += [pa.array(c, pa.int32() if n in (0, 4) else pa.int64()) for n, c in enumerate(cells)]
                out += [pa.array(parts, pa.binary())] if with_ids else []
                names = [id_col, "piece", "start", "length", "ids_crc32", "chunk", "place"]
                yield pa.RecordBatch.from_arrays(out, names + ["ids"] * with_ids)

    return docs.select(col(id_col), col(text_col)).mapInArrow(cut, f"`{id_col}` {kind}, {made}")


def two_fit_patterns(counts: np.ndarray) -> list[tuple[int, list[int]]]:
    """Bins as ``(how many, lengths)`` that hold ``counts[n]`` pieces of each length ``n``.

    A bin is filled with the longest piece that still fits, again and again.  Then
    its shortest piece is taken out as long as two unpacked ones fill the widened
    gap more tightly; the closest such pair goes in.  Bins made alike are made at
    once, as many as the counts allow, so the work depends on the capacity alone.
    """
    left, capacity = counts.astype(np.int64).copy(), len(counts) - 1
    sizes = np.arange(capacity + 1)
    patterns = []
    while left.any():
        free, bin_, gap = left.copy(), [], capacity
        while gap and (fits := np.flatnonzero(free[1:gap + 1])).size:
            size = int(fits[-1]) + 1
            bin_.append(size)
            free[size] -= 1
            gap -= size
        while gap and bin_:
            least = min(bin_)
            room = gap + least
            first = np.flatnonzero(free[:room])  # leaves at least one for the other
            if not first.size:
                break
            most = np.maximum.accumulate(np.where(free[:room + 1] > 0, sizes[:room + 1], 0))
            other = most[room - first]
            # A length that is there once can't be its own partner: the next shorter one is.
            alone = (other == first) & (free[first] < 2)
            other = np.where(alone, most[np.maximum(other - 1, 0)], other)
            total = np.where(other > 0, first + other, 0)
            best = int(total.argmax())
            if total[best] <= least:
                break
            bin_.remove(least)
            free[least] += 1
            for size in (int(first[best]), int(other[best])):
                bin_.append(size)
                free[size] -= 1
            gap = room - int(total[best])
        used = np.bincount(bin_, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= times * used
        patterns.append((times, sorted(bin_, reverse=True)))
    return patterns


def slots(patterns: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, by first rank: the ranks' first, pieces per bin, first bin, first offset."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    next_rank: dict[int, int] = {}
    first_bin = 0
    for times, bin_ in patterns:
        offset = 0
        for size in sorted(set(bin_), reverse=True):
            per_bin = bin_.count(size)
            rank = next_rank.get(size, 0)
            out.setdefault(size, []).append((rank, per_bin, first_bin, offset))
            next_rank[size] = rank + times * per_bin
            offset += size * per_bin
        first_bin += times
    return {size: tuple(np.array(rows, np.int64).T) for size, rows in out.items()}


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give :func:`token_pieces` a ``sequence_id`` and an ``offset`` in it.

    Pieces of one length are alike to the packing, so it works on the number of
    pieces of each length: ``capacity`` numbers, whatever the size of the table.
    A piece finds its place by its rank among those of its length, which is its
    number within its task plus what the tasks before have of that length.
    """
    pieces = materialize(pieces)
    counts = materialize(pieces.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n")))
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # capacity rows
    histogram = np.zeros(capacity + 1, np.int64)
    for row in lengths:
        histogram[row["length"]] = row["n"]
    table = slots(two_fit_patterns(histogram))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        "chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    ranked = pieces.join(shifts, ["chunk", "length"]).withColumn("rank", F.col("place") + F.col("shift"))
    inner = [c for c in pieces.columns if c not in ("chunk", "place")]
    ranked = ranked.select(*[col(c) for c in inner], "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for one in np.unique(size):
                at = np.flatnonzero(size == one)
                first, per_bin, first_bin, first_offset = table[int(one)]
                k = np.searchsorted(first, rank[at], "right") - 1
                inside = rank[at] - first[k]
                sequence[at] = first_bin[k] + inside // per_bin[k]
                offset[at] = first_offset[k] + inside % per_bin[k] * one
            cells = [batch.column(c) for c in inner] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(cells, [*inner, "sequence_id", "offset"])

    schema = pieces.select(*[col(c) for c in inner]).schema
    return ranked.mapInArrow(place, schema.add("sequence_id", "long").add("offset", "long"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """Pack every text into sequences of at most ``capacity`` ids.

    Nulls: a null text is empty and is one piece with the closing id alone; a null id
    is kept.  Only texts longer than ``capacity`` are cut.  Repeated rows are packed
    one by one.  No rows give no rows; columns besides id and text are not looked at.
    """
    return pack_pieces(token_pieces(docs, tokenizer, capacity, **options), capacity)
