"""Arrow kernels for dense vectors.

Spark 4.1 has no vector functions, and ``aggregate(zip_with(...))`` leaves code
generation and boxes every element, so the dot products and the matrix product
run in numpy on whole Arrow batches.  The batches stream: a task never holds more
than one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fv

# Scores are rounded here so that exact copies tie exactly: a matrix product may
# differ in the last bit with a row's place in its batch.
SCORE_DIGITS = 10


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as an (n, d) float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.empty((0, 0))
    lengths = pc.list_value_length(column)
    if column.null_count or pc.min(lengths).as_py() != pc.max(lengths).as_py():
        raise ValueError("vectors must be non-null and of one dimension")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(column), -1)


def lists(values: np.ndarray, kind: pa.DataType = pa.float64()) -> pa.Array:
    """An (n, d) matrix as a list column."""
    n, d = values.shape
    offsets = pa.array(np.arange(0, n * d + 1, max(d, 1), dtype=np.int32)[: n + 1])
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), type=kind))


def normalize(x: np.ndarray, epsilon: float = fv.NORM_EPSILON) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=-1, keepdims=True) + epsilon)


def transform(x: np.ndarray, w: np.ndarray | None) -> np.ndarray:
    """Rows through ``W`` (when there is one), then to unit length."""
    return normalize(x if w is None else x @ w)


def _map_vectors(df: DataFrame, column: str, out: str, kernel) -> DataFrame:
    """Replace ``column`` by ``out``, computed batch by batch.

    Only the vectors go to Python; the other columns stay in the JVM.
    """

    def run(v: pa.Array) -> pa.Array:
        return lists(kernel(matrix(v))) if len(v) else pa.array([], pa.list_(pa.float64()))

    computed = F.arrow_udf(run, "array<double>")(F.col(column)).alias(out)
    return df.select(*[c for c in df.columns if c != column], computed)


def apply_transform(
    df: DataFrame, w: np.ndarray | None, column: str = "role_vec", out: str = "clean_vec"
) -> DataFrame:
    """Project ``column`` through ``W`` and renormalise."""
    if w is None:
        return _map_vectors(df, column, out, normalize)
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(w, dtype=np.float64))
    return _map_vectors(df, column, out, lambda x: transform(x, shared.value))


def l2_normalize(
    df: DataFrame, column: str, out: str, epsilon: float = fv.NORM_EPSILON
) -> DataFrame:
    """B17.  ``epsilon=0`` gives the embedder's form, which leaves zero vectors alone."""

    def kernel(x: np.ndarray) -> np.ndarray:
        if epsilon:
            return normalize(x, epsilon)
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(norm > 0, norm, 1.0)

    return _map_vectors(df, column, out, kernel)


def cosine_scores(
    df: DataFrame, targets: np.ndarray, column: str = "role_vec", out: str = "scores"
) -> DataFrame:
    """Cosine of every row with each of a few target vectors."""
    unit = normalize(np.asarray(targets, dtype=np.float64))
    shared = df.sparkSession.sparkContext.broadcast(unit)
    return _map_vectors(
        df, column, out, lambda x: np.round(normalize(x) @ shared.value.T, SCORE_DIGITS)
    )


def centroid_scores(
    df: DataFrame, raw: np.ndarray, clean: np.ndarray, w: np.ndarray | None,
    column: str = "role_vec",
) -> DataFrame:
    """Per row, R raw cosines and R deconfounded ones, in one pass.

    The vector is dropped here, so later shuffles carry keys and doubles only.
    """
    shared = df.sparkSession.sparkContext.broadcast(
        (normalize(np.asarray(raw, dtype=np.float64)), np.asarray(clean, dtype=np.float64), w)
    )
    roles = len(raw)

    def kernel(x: np.ndarray) -> np.ndarray:
        raw_unit, clean_unit, matrix_w = shared.value
        both = np.hstack([normalize(x) @ raw_unit.T, transform(x, matrix_w) @ clean_unit.T])
        return np.round(both, SCORE_DIGITS)

    scored = _map_vectors(df, column, "both", kernel)
    keep = [c for c in df.columns if c != column]
    return scored.select(
        *keep,
        F.slice("both", 1, roles).alias("raw_scores"),
        F.slice("both", roles + 1, roles).alias("clean_scores"),
    )


def role_sums(df: DataFrame, w: np.ndarray | None) -> DataFrame:
    """Per task and role: row count and summed raw and deconfounded vectors.

    A task emits one row per role, so the shuffle that follows does not grow with
    the size of a center.
    """
    shared = df.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(1))
            both = np.hstack([x, transform(x, shared.value)])
            names = np.asarray(b.column(0).to_pylist())
            for role in np.unique(names):
                mine = both[names == role]
                n, total = totals.get(role, (0, 0.0))
                totals[role] = (n + len(mine), total + mine.sum(axis=0))
        if totals:
            total = np.stack([t for _, t in totals.values()])
            d = total.shape[1] // 2
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([str(r) for r in totals]), pa.array([n for n, _ in totals.values()]),
                    lists(total[:, :d]), lists(total[:, d:]),
                ],
                names=["role", "n", "raw", "clean"],
            )

    return df.select("role", "role_vec").mapInArrow(
        run, "role string, n long, raw array<double>, clean array<double>"
    )


def vector_sum(c: Column | str) -> Column:
    """Element-wise sum as an aggregate with map-side partials."""
    c = F.col(c) if isinstance(c, str) else c
    return vector_to_array(Summarizer.sum(array_to_vector(c)))


def vector_mean(c: Column | str) -> Column:
    """Element-wise mean as an aggregate with map-side partials."""
    c = F.col(c) if isinstance(c, str) else c
    return vector_to_array(Summarizer.mean(array_to_vector(c)))


def dot(a: Column, b: Column) -> Column:
    """Dot product as a plain expression, for short vectors and few rows."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
