"""Words of many texts at once: where they are and a 64-bit hash of each, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
# An odd base and its inverse modulo 2**64, for hashes that are differences of running sums.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        factors = np.full(max(n, 2 * len(_powers[base])), base, np.uint64)
        factors[0] = 1
        _powers[base] = np.multiply.accumulate(factors)
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()


@dataclass
class Words:
    """Words in text order: ``data[start[i]:end[i]]`` belongs to text ``text[i]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray

    def strings(self, at: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.start[at].tolist(), self.end[at].tolist())]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes; a longer text is a run by itself."""
    _, offsets = text_bytes(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(to, len(texts))
        at = to


def word_bounds(data: np.ndarray, offsets: np.ndarray, blanks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the maximal runs of bytes that aren't ``blanks`` begin and end; none reaches another text."""
    n = len(data)
    inside = ~blanks[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < n]
    first[begins] |= inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    stops = offsets[1:][offsets[1:] > 0] - 1
    last[stops] |= inside[stops]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """All words in order by their numbers, how many each text has, and the distinct words.

    A-Z are lowered; words are told apart by all their bytes.
    """
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    start, end = word_bounds(data, offsets, BLANKS)
    counts = np.diff(np.searchsorted(start, offsets))
    ends = np.append(0, np.cumsum(end - start))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[~BLANKS[data]])]
    ).dictionary_encode()
    return words.indices.to_numpy(), counts, words.dictionary


def find_words(texts: pa.Array, blanks: np.ndarray = BLANKS, lower: bool = True) -> Words:
    """All maximal runs of bytes that aren't ``blanks``, with hashes, A-Z lowered on request."""
    data, offsets = text_bytes(texts)
    data = LOWER[data] if lower else data
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, none, none.astype(np.uint64))
    start, end = word_bounds(data, offsets, blanks)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * powers(INVERSE, n)[start])
    text = np.searchsorted(offsets, start, "right") - 1
    return Words(data, offsets, start, end, text, hashes)
