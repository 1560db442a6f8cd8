"""Fitting and judging the deconfounding matrix ``W``.

A pair table is ``url_hash, company, title, role_vec, resp_vec``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.vectors import (
    SCORE_DIGITS, apply_transform, dot, lists, matrix, normalize, vector_sum,
)
from ..session import lookup_join, materialize
from .topk import global_rank

# --- I1: the stored matrix ---------------------------------------------------


def save_transform(spark: SparkSession, w: np.ndarray, path: str) -> None:
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(w)]
    spark.createDataFrame(rows, "i int, row array<double>").coalesce(1).write.mode(
        "overwrite"
    ).parquet(path)


def load_transform(spark: SparkSession, path: str) -> np.ndarray | None:
    """``W`` from parquet, or from an ``.npz`` under key ``W``; None if absent.

    The matrix is d x d, so its size does not depend on the data.
    """
    if path.endswith(".npz"):
        try:
            with np.load(path) as stored:
                return np.asarray(stored["W"], dtype=np.float64) if "W" in stored else None
        except FileNotFoundError:
            return None
    try:
        rows = spark.read.parquet(path).orderBy("i").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return np.array([r["row"] for r in rows]) if rows else None


# --- I5: the fit -------------------------------------------------------------


def gram_sums(pairs: DataFrame, x: str = "role_vec", y: str = "resp_vec") -> tuple[np.ndarray, np.ndarray]:
    """``X'X`` and ``X'Y``: per-task partial sums, then a sum per matrix row."""

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                xs, ys = matrix(b.column(0)), matrix(b.column(1))
                part = xs.T @ np.hstack([xs, ys])
                total = part if total is None else total + part
        if total is not None:
            index = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([index, lists(total)], names=["i", "row"])

    rows = (
        pairs.select(x, y).mapInArrow(partials, "i int, row array<double>")
        .groupBy("i").agg(vector_sum("row").alias("row")).orderBy("i").collect()
    )
    if not rows:
        raise ValueError("no pairs to fit on")
    both = np.array([r["row"] for r in rows])
    return both[:, : len(both)], both[:, len(both):]


def solve_transform(xx: np.ndarray, xy: np.ndarray, lam: float, alpha: float) -> np.ndarray:
    """Wiener-weighted shared directions, then ridge onto the target, as one matrix."""
    u, s, _ = np.linalg.svd(xy)
    basis = u[:, : len(s)] * (s / (s + lam))
    ridge = basis.T @ xx @ basis + alpha * np.eye(basis.shape[1])
    return basis @ np.linalg.solve(ridge, basis.T @ xy)


def fit_deconfound(pairs: DataFrame, lam: float, alpha: float) -> np.ndarray:
    """One pass over the pairs; the driver solves a d x d system."""
    return solve_transform(*gram_sums(pairs), lam, alpha)


def company_folds(df: DataFrame, k: int) -> DataFrame:
    """A fold per row such that no company is in two folds."""
    number = F.conv(F.substring(F.md5("company"), 1, 15), 16, 10).cast("long")
    return df.withColumn("fold", F.pmod(number, F.lit(k)).cast("int"))


# --- I5-I10: the held-out protocol ---


def fold_gram_sums(
    pairs: DataFrame, k: int, x: str = "role_vec", y: str = "resp_vec"
) -> tuple[np.ndarray, np.ndarray]:
    """``X'X`` and ``X'Y`` of each of ``k`` folds (column ``fold``), all in one pass."""

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            fold, xs, ys = b.column(0).to_numpy(), matrix(b.column(1)), matrix(b.column(2))
            for f in np.unique(fold):
                mine = xs[fold == f]
                part = mine.T @ np.hstack([mine, ys[fold == f]])
                totals[int(f)] = totals.get(int(f), 0.0) + part
        for f, total in totals.items():
            index = pa.array(np.arange(len(total), dtype=np.int32))
            cells = [pa.array(np.full(len(total), f, np.int32)), index, lists(total)]
            yield pa.RecordBatch.from_arrays(cells, names=["fold", "i", "row"])

    rows = (
        pairs.select("fold", x, y).mapInArrow(partials, "fold int, i int, row array<double>")
        .groupBy("fold", "i").agg(vector_sum("row").alias("row")).collect()
    )
    if not rows:
        raise ValueError("no pairs to fit on")
    d = len(rows[0]["row"]) // 2
    both = np.zeros((k, d, 2 * d))
    for r in rows:
        both[r["fold"], r["i"]] = r["row"]
    return both[:, :, :d], both[:, :, d:]


def cross_validate(
    pairs: DataFrame, k: int = 5, lam: float = 1.0, alpha: float = 1e-3, neighbors: int = 20
) -> DataFrame:
    """The four measures on each held-out fold of companies, raw and with a matrix fitted on the others.

    One pass gives the sums of all folds; what a fold is judged by is fitted on all sums
    less its own.  Columns: ``fold``, ``n`` and for each of rnp, rrc, ci and r2 ``raw_*`` and
    ``clean_*``, null where a fold cannot tell.  A fold without pairs gives no row.
    """
    spark = pairs.sparkSession
    folds = materialize(company_folds(pairs, k))
    xx, xy = fold_gram_sums(folds, k)
    sizes = {r["fold"]: r["count"] for r in folds.groupBy("fold").count().collect()}
    measures = ["rnp", "rrc", "ci", "r2"]
    out = []
    for fold in sorted(sizes):
        held = folds.filter(F.col("fold") == fold).drop("fold")
        w = solve_transform(xx.sum(axis=0) - xx[fold], xy.sum(axis=0) - xy[fold], lam, alpha)
        # What is nearest by the target does not depend on the matrix.
        near = materialize(exact_knn(held, "resp_vec", neighbors).select("query", "neighbor"))
        both = [evaluate(held, m, neighbors, near) for m in (None, w)]
        out.append((fold, sizes[fold], *[e[m] for m in measures for e in both]))
    names = ", ".join(f"raw_{m} double, clean_{m} double" for m in measures)
    return spark.createDataFrame(out, f"fold int, n long, {names}")


# --- I7: neighbors kept ------------------------------------------------------

# Below the first size blocks are not cut for the sake of idle cores; the second bounds the
# vectors of a block in a task.
QUERY_ROWS = 4096
BLOCK_BYTES = 32 * 1024 * 1024
# Similarities that a task holds at once.
SCORES_AT_ONCE = 4 * 1024 * 1024


def block_count(rows: int, dimension: int, cores: int) -> int:
    """How many blocks: every row is sent once to each, so no more than cores and memory ask for.

    Three pairs of blocks per core keep all cores busy; beyond that blocks grow with the
    table until they reach BLOCK_BYTES, and only then their number does.
    """
    largest = max(QUERY_ROWS, BLOCK_BYTES // (8 * max(dimension, 1)))
    busy = math.ceil(math.sqrt(6 * cores))
    return max(1, -(-rows // largest), min(busy, -(-rows // QUERY_ROWS)))


def exact_knn(
    vectors: DataFrame, column: str, k: int, key: str = "url_hash", query_rows: int | None = None
) -> DataFrame:
    """Exact k nearest others of every row by cosine: ``query, neighbor, sim, rank``.

    Rows fall into blocks (see :func:`block_count`; of about ``query_rows``, if given) by a
    hash of their key, and every two blocks meet in one group, which keeps the k best of
    each row.  The plan has the same few steps at any size, no group is larger than two
    blocks, and nothing passes through the driver.  The work is quadratic: this is an
    evaluation tool for held-out folds, not a way to search the corpus.
    """
    slim = materialize(vectors.select(F.col(key).alias("id"), F.col(column).alias("v")))
    size = slim.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    if query_rows is None:
        blocks = block_count(size["n"], size["d"] or 1, vectors.sparkSession.sparkContext.defaultParallelism)
    else:
        blocks = max(1, -(-size["n"] // query_rows))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    met = slim.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")

    def nearest(group: pa.Table) -> pa.Table:
        return _nearest(group, k)

    found = met.select(low, high, "own", "id", "v").groupBy("low", "high").applyInArrow(
        nearest, "query long, neighbor long, sim double"
    )
    # One group per other block gave k rows at most.
    order = Window.partitionBy("query").orderBy(F.col("sim").desc(), "neighbor")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _nearest(group: pa.Table, k: int) -> pa.Table:
    """The k best of each row among those of the other block, ties to the lower key."""
    group = group.combine_chunks().sort_by("id")
    ids, own = group["id"].to_numpy(), group["own"].to_numpy()
    unit = normalize(matrix(group["v"]))
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    ways = [(low, high)] if low == high else [(low, high), (high, low)]
    query, neighbor, sim = [], [], []
    for a, b in ways:
        asked, given = np.flatnonzero(own == a), np.flatnonzero(own == b)
        step = max(1, SCORES_AT_ONCE // max(1, len(given)))
        targets = unit[given].T
        for at in range(0, len(asked), step):
            some = asked[at:at + step]
            sims = np.round(unit[some] @ targets, SCORE_DIGITS)
            sims[ids[some][:, None] == ids[given][None, :]] = -np.inf
            for i, row in zip(some, sims):
                best = np.arange(len(row))
                if len(row) > k:
                    best = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
                # The rows are in key order, so a stable sort leaves ties to the lower key.
                best = best[np.argsort(-row[best], kind="stable")][:k]
                best = best[np.isfinite(row[best])]
                query.append(np.full(len(best), ids[i]))
                neighbor.append(ids[given[best]])
                sim.append(row[best])
    none = [np.zeros(0)]
    return pa.table({
        "query": np.concatenate(query or none).astype(np.int64),
        "neighbor": np.concatenate(neighbor or none).astype(np.int64),
        "sim": np.concatenate(sim or none).astype(float),
    })


def knn_preservation(
    pairs: DataFrame, k: int = 20, w: np.ndarray | None = None, query_rows: int | None = None,
    near: DataFrame | None = None,
) -> DataFrame:
    """Mean share of a row's k nearest by ``resp_vec`` that ``role_vec`` also has.

    ``near`` has the first (``query, neighbor``) where they are known already.
    """
    role = pairs.select("url_hash", F.col("role_vec").alias("v"))
    if w is not None:
        role = apply_transform(role, w, "v", "v")
    kept = exact_knn(role, "v", k, query_rows=query_rows).select("query", "neighbor")
    if near is None:
        near = exact_knn(pairs, "resp_vec", k, query_rows=query_rows).select("query", "neighbor")
    marked = near.join(kept.withColumn("hit", F.lit(1)), ["query", "neighbor"], "left")
    per_query = marked.groupBy("query").agg(
        (F.count("hit") / F.count("*")).alias("share")
    )
    return per_query.agg(F.avg("share").alias("rnp"), F.count("*").alias("n_queries"))


# --- I8: rank correlation ----------------------------------------------------


def hashed_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of neighbours in the order of the key's hash, every row in one of them.

    Rows are ranked by range partitioning and joined two by two; of an odd number the
    last row goes with the one before it, which then is in two pairs.
    """
    order = [F.md5(F.col("url_hash").cast("string")), F.col("url_hash")]
    placed = global_rank(pairs, order, "_place")
    n = placed.count()
    place, row = F.col("_place"), F.struct(*pairs.columns)
    pair = F.floor((place - 1) / 2).alias("pair")
    first = placed.filter((place % 2 == 1) & (place < n)).select(pair, row.alias("a"))
    second = placed.filter(place % 2 == 0).select(pair, row.alias("b"))
    if n % 2 and n > 1:
        left = F.lit(-1).cast("long").alias("pair")
        first = first.unionAll(placed.filter(place == n).select(left, row.alias("a")))
        second = second.unionAll(placed.filter(place == n - 1).select(left, row.alias("b")))
    return first.join(second, "pair")


def _mean_ranks(values: DataFrame, column: str, rank: str) -> DataFrame:
    """Distinct values with their tie-averaged rank."""
    counted = values.groupBy(column).agg(F.count("*").alias("_n"))
    ranked = global_rank(counted, [F.col(column)], "_first", weight=F.col("_n"))
    return ranked.select(column, (F.col("_first") + (F.col("_n") - 1) / 2).alias(rank))


def rank_correlation(pairs: DataFrame, w: np.ndarray | None = None) -> DataFrame:
    """I8: Spearman correlation of role and resp similarities over :func:`hashed_pairs`."""
    clean = apply_transform(pairs.select("url_hash", "role_vec", "resp_vec"), w, "role_vec", "_r")
    clean = apply_transform(clean, None, "resp_vec", "_p")
    drawn = hashed_pairs(
        clean.select("url_hash", F.col("_r").alias("role_vec"), F.col("_p").alias("resp_vec"))
    )
    sims = materialize(drawn.select(
        F.round(dot(F.col("a.role_vec"), F.col("b.role_vec")), SCORE_DIGITS).alias("role_sim"),
        F.round(dot(F.col("a.resp_vec"), F.col("b.resp_vec")), SCORE_DIGITS).alias("resp_sim"),
    ))
    # Equal pairs are counted first, so the rank lookups meet distinct rows only.
    counted = sims.groupBy("role_sim", "resp_sim").agg(F.count("*").alias("n"))
    ranked = lookup_join(counted, _mean_ranks(sims, "role_sim", "x"), ["role_sim"], "inner")
    ranked = lookup_join(ranked, _mean_ranks(sims, "resp_sim", "y"), ["resp_sim"], "inner")
    middle = (sims.count() + 1) / 2
    x, y, n = F.col("x") - middle, F.col("y") - middle, F.col("n")
    return ranked.agg(
        F.try_divide(F.sum(n * x * y), F.sqrt(F.sum(n * x * x) * F.sum(n * y * y))).alias("rrc"),
        F.sum("n").alias("n_pairs"),
    )


# --- I9: company invariance --------------------------------------------------


def company_invariance(pairs: DataFrame, w: np.ndarray | None = None) -> DataFrame:
    """Mean cosine over same-title pairs of different companies.

    For unit vectors the sum over such pairs is half of what the title's summed
    vector has in squared length beyond those of its companies, so no pair is
    ever formed.
    """
    unit = apply_transform(pairs.select("title", "company", "role_vec"), w, "role_vec", "v")
    squared: dict[str, Column] = {
        c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x) for c in ("v", "total")
    }
    per_company = unit.groupBy("title", "company").agg(
        vector_sum("v").alias("v"), F.count("*").alias("n")
    )
    per_title = per_company.groupBy("title").agg(
        vector_sum("v").alias("total"), F.sum(squared["v"]).alias("own"),
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n_own"),
    )
    cross = per_title.select(
        ((squared["total"] - F.col("own")) / 2).alias("sim"),
        ((F.col("n") * F.col("n") - F.col("n_own")) / 2).alias("pairs"),
    )
    return cross.agg(
        F.try_divide(F.sum("sim"), F.sum("pairs")).alias("ci"),
        F.sum("pairs").cast("long").alias("n_pairs"),
    )


# --- I10: reconstruction -----------------------------------------------------


def reconstruction_r2(pairs: DataFrame, w: np.ndarray | None = None) -> DataFrame:
    """Share of the variance of ``resp_vec`` that ``role_vec @ W`` explains."""
    shared = pairs.sparkSession.sparkContext.broadcast(w)

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, error, square, total = 0, 0.0, 0.0, None
        for b in batches:
            if not b.num_rows:
                continue
            x, y = matrix(b.column(0)), matrix(b.column(1))
            fit = x if shared.value is None else x @ shared.value
            n += len(y)
            error += float(((y - fit) ** 2).sum())
            square += float((y ** 2).sum())
            total = y.sum(axis=0) if total is None else total + y.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([error]), pa.array([square]), lists(total[None, :])],
                names=["n", "error", "square", "total"],
            )

    sums = (
        pairs.select("role_vec", "resp_vec")
        .mapInArrow(partials, "n long, error double, square double, total array<double>")
        .agg(
            F.sum("n").alias("n"), F.sum("error").alias("error"), F.sum("square").alias("square"),
            vector_sum("total").alias("total"),
        )
    )
    spread = F.col("square") - F.aggregate("total", F.lit(0.0), lambda s, x: s + x * x) / F.col("n")
    return sums.select((1 - F.try_divide(F.col("error"), spread)).alias("r2"), F.col("n"))


def evaluate(
    pairs: DataFrame, w: np.ndarray | None, k: int = 20, near: DataFrame | None = None
) -> dict[str, float]:
    """The four numbers for one (held-out) pair table; ``near`` as in :func:`knn_preservation`."""
    return {
        "rnp": knn_preservation(pairs, k, w, near=near).first()["rnp"],
        "rrc": rank_correlation(pairs, w=w).first()["rrc"],
        "ci": company_invariance(pairs, w).first()["ci"],
        "r2": reconstruction_r2(pairs, w).first()["r2"],
    }


__all__ = [
    "block_count", "company_folds", "company_invariance", "cross_validate", "evaluate", "exact_knn", "fit_deconfound",
    "fold_gram_sums", "fv", "gram_sums", "knn_preservation", "load_transform", "rank_correlation",
    "reconstruction_r2", "hashed_pairs", "save_transform", "solve_transform",
]
