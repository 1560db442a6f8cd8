"""Rows of a large table by keys: a Bloom filter where the table is scanned, a join after it.

Only rows that pass the filter are ever exchanged, so the table itself stays where it is
however many keys there are.  The filter has a proven size; beyond it, more rows pass in
vain and the join drops them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
HASHES = 5
LEAST_BITS, MOST_BITS = 13, 28


def spread_bits(key: np.ndarray) -> np.ndarray:
    h = key.astype(np.int64).view(np.uint64)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def places(key: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Where a key's bits are, by one hash and multiples of its other half."""
    h = spread_bits(key)
    step = (h >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield (h + np.uint64(k) * step) & np.uint64((1 << bits) - 1)


class KeyFilter:
    """A Bloom filter of ``2 ** bits`` bits, given as 64-bit words."""

    def __init__(self, words: np.ndarray, bits: int) -> None:
        self.words, self.bits = words, bits

    def passes(self, key: np.ndarray) -> np.ndarray:
        out = np.ones(len(key), bool)
        for at in places(key, self.bits):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) == 1
        return out


def key_filter(keys: DataFrame, key: str, most_bits: int = MOST_BITS) -> KeyFilter:
    """The filter of the keys, which tasks build in parts: at most ``2 ** most_bits`` bits."""
    wanted = int(np.ceil(np.log2(BITS_PER_KEY * max(keys.count(), 1))))
    bits = max(LEAST_BITS, min(wanted, most_bits))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << (bits - 6), np.uint64)
        for batch in batches:
            for at in places(batch.column(0).to_numpy(), bits):
                np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], ["word", "bits"])

    marked = keys.select(key).mapInArrow(mark, "word long, bits long")
    table = marked.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return KeyFilter(words, bits)


def filtered(table: DataFrame, keys: DataFrame, key: str, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``table`` that may have one of the keys; only keys are handed to Python."""
    found = key_filter(keys, key, most_bits)
    shared = table.sparkSession.sparkContext.broadcast((found.words, found.bits))

    def test(column: pa.Array) -> pa.Array:
        return pa.array(KeyFilter(*shared.value).passes(column.to_numpy(zero_copy_only=False)))

    return table.filter(F.arrow_udf(test, "boolean")(F.col(key)))


def join_keys(table: DataFrame, keys: DataFrame, key: str = "url_hash", how: str = "inner") -> DataFrame:
    """``table`` joined with ``keys`` on ``key``, which is long and not null in ``table``.

    ``keys`` is read twice, so it should be a written table.
    """
    return filtered(table, keys, key).join(keys, key, how)
