"""Sorted, front-coded runs of suffixes, and their merge by a loser tree that knows prefixes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


def shared_length(a: bytes, b: bytes, known: int) -> int:
    """How many first bytes two strings share, ``known`` of which need no look."""
    n, most = known, min(len(a), len(b))
    while n < most:
        step = min(16, most - n)
        if a[n:n + step] == b[n:n + step]:
            n += step
            continue
        while a[n] == b[n]:
            n += 1
        break
    return n


@dataclass
class Run:
    """Suffixes in order with what each shares with the one before, and what belongs to them.

    ``left`` is the text before a suffix, ``pos`` where that begins, ``span`` how many
    windows after the first one are asked about.
    """

    suffix: list[bytes]
    shared: list[int]
    left: list[bytes]
    pos: np.ndarray
    span: np.ndarray


def pack_run(suffix: list[bytes], left: list[bytes], pos: np.ndarray, span: np.ndarray) -> bytes:
    """Front-code sorted suffixes: of each, only what it doesn't share with the one before."""
    n, shared = len(suffix), [0]
    for a, b in zip(suffix, suffix[1:]):
        shared.append(shared_length(a, b, 0))
    tails = [s[k:] for s, k in zip(suffix, shared)]
    head = np.array([n], "<i8").tobytes()
    sizes = np.array([shared, [len(t) for t in tails], [len(x) for x in left], span], "<u2").tobytes()
    return zlib.compress(head + sizes + pos.astype("<i8").tobytes() + b"".join(tails) + b"".join(left), 1)


def unpack_run(blob: bytes) -> Run:
    blob = zlib.decompress(blob)
    n = int(np.frombuffer(blob, "<i8", 1)[0])
    shared, tail, left, span = np.frombuffer(blob, "<u2", 4 * n, 8).reshape(4, n).astype(np.int64)
    pos = np.frombuffer(blob, "<i8", n, 8 + 8 * n)
    at, suffix, last = 8 + 16 * n, [], b""
    for k, size in zip(shared.tolist(), tail.tolist()):
        last = last[:k] + blob[at:at + size]
        at += size
        suffix.append(last)
    lefts = []
    for size in left.tolist():
        lefts.append(blob[at:at + size])
        at += size
    return Run(suffix, shared.tolist(), lefts, pos, span)


def merge_runs(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """``run, index, shared`` of all suffixes in order; ``shared`` with the one put out before.

    A loser tree whose players carry what they share with the last winner.  Of two
    players, the one that shares more is the smaller, without a look at the bytes;
    only equal ones are compared, from there on, and the loser keeps what the two
    share.  A run's own front code gives its next player's number.
    """
    size = 1
    while size < len(runs):
        size *= 2
    length = [len(r.suffix) for r in runs] + [0] * (size - len(runs))
    index, known = [0] * size, [0] * size

    def beats(a: int, b: int) -> int:
        """The winner of two; the loser's ``known`` is brought up to date."""
        if index[a] >= length[a]:
            return b
        if index[b] >= length[b]:
            return a
        if known[a] != known[b]:
            return a if known[a] > known[b] else b
        x, y = runs[a].suffix[index[a]], runs[b].suffix[index[b]]
        n = shared_length(x, y, known[a])
        if n == len(x) or n < len(y) and x[n] < y[n]:
            known[b] = n
            return a
        known[a] = n
        return b

    tree = [-1] * size
    level = list(range(size))
    at = size
    while at > 1:
        at //= 2
        winners = []
        for k in range(at):
            a, b = level[2 * k], level[2 * k + 1]
            won = beats(a, b)
            tree[at + k] = b if won == a else a
            winners.append(won)
        level = winners
    winner = level[0]
    while index[winner] < length[winner]:
        yield winner, index[winner], known[winner]
        index[winner] += 1
        if index[winner] < length[winner]:
            known[winner] = runs[winner].shared[index[winner]]
        node = (size + winner) // 2
        while node:
            won = beats(winner, tree[node])
            if won != winner:
                winner, tree[node] = won, winner
            node //= 2
