"""Cuts of score arrays, one score per role, without a row per listing and role.

Kernels see the arrays as matrices.  A first pass gives a histogram per role, a second one
only the rows at or above the bin where the role's cut falls, so what grows with roles
times listings never leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import matrix
from .topk import BINS

SCORED = "role string, url_hash long, center_of array<string>, raw_score double, clean_score double"
# Rows held per role before the least are picked out.
HELD = 4096


def bins_of(scores: np.ndarray) -> np.ndarray:
    """Bins of scores from 1 down to -1, counted from the greatest."""
    return np.clip(np.floor((1.0 - scores) * (BINS / 2)), 0, BINS).astype(np.int64)


def histograms(wide: DataFrame, roles: list[str]) -> np.ndarray:
    """Per role, how many listings have a raw score in each bin."""
    n = len(roles)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * (BINS + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                cells = bins_of(matrix(batch.column(0))) + np.arange(n) * (BINS + 1)
                total += np.bincount(cells.ravel(), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    counted = wide.select("raw_scores").mapInArrow(count, "cell long, n long")
    # At most roles * (BINS + 1) rows.
    table = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n * (BINS + 1), np.int64)
    out[table["cell"].to_numpy()] = table["n"].to_numpy()
    return out.reshape(n, BINS + 1)


def edges(histogram: np.ndarray, widths: list[int]) -> np.ndarray:
    """Per role the bin in which its cut falls; the last one if all are wanted."""
    upto = np.cumsum(histogram, axis=1)
    reached = upto >= np.array(widths)[:, None]
    return np.where(reached.any(axis=1), reached.argmax(axis=1), BINS)


def role_rows(batch: pa.RecordBatch, roles: list[str], role: np.ndarray, at: np.ndarray, *scores: np.ndarray):
    """Rows of SCORED, or of its first columns and one score, for listings ``at`` of a batch."""
    names = pa.array(roles, pa.string()).take(pa.array(role))
    return [names, batch.column("url_hash").take(pa.array(at)), *[pa.array(s[at, role]) for s in scores]]


def rows_above(wide: DataFrame, roles: list[str], edge: np.ndarray) -> DataFrame:
    """Rows of SCORED at or above each role's edge."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw, clean = matrix(batch.column("raw_scores")), matrix(batch.column("clean_scores"))
            at, role = np.nonzero(bins_of(raw) <= edge)
            name, key, *scores = role_rows(batch, roles, role, at, raw, clean)
            center = batch.column("center_of").take(pa.array(at))
            yield pa.RecordBatch.from_arrays([name, key, center, *scores], [c.split()[0] for c in SCORED.split(", ")])

    return wide.select("url_hash", "center_of", "raw_scores", "clean_scores").mapInArrow(emit, SCORED)


def above_cut(wide: DataFrame, roles: list[str], widths: dict[str, int]) -> DataFrame:
    """Rows of SCORED that hold each role's first ``widths[role]`` by raw score, and few others."""
    order = [max(widths[r], 0) for r in roles]
    return rows_above(wide, roles, edges(histograms(wide, roles), order))


def lowest(wide: DataFrame, roles: list[str], size: int) -> DataFrame:
    """``role, url_hash, raw_score`` of plain listings that hold each role's ``size`` least.

    Every task gives its own least, ties to the lower key.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0), np.zeros(0, np.int64)) for _ in roles]

        def least(k: int, most: int) -> None:
            score, key = held[k]
            if len(score) > most:
                order = np.lexsort((key, score))[:size]
                held[k] = score[order], key[order]

        for batch in batches:
            if not batch.num_rows:
                continue
            raw, key = matrix(batch.column(1)), batch.column(0).to_numpy()
            for k in range(len(roles)):
                held[k] = np.append(held[k][0], raw[:, k]), np.append(held[k][1], key)
                least(k, max(size, HELD))
        for k, role in enumerate(roles):
            least(k, size)
            score, key = held[k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([role] * len(score), pa.string()), pa.array(key), pa.array(score)],
                ["role", "url_hash", "raw_score"],
            )

    plain = wide.filter("plain").select("url_hash", "raw_scores")
    return plain.mapInArrow(pick, "role string, url_hash long, raw_score double")
