"""Exact top-k search by a Voronoi kNN join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.topk import top_k
from ..session import materialize
from .common import col

PIVOTS = 16
# Rows of one local problem: queries of a block against candidates of a slice.
BLOCK, SLICE = 1000, 8000


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id, v`` with v = floor(scale * x) as doubles, of the vectors that are all finite."""
    x = F.transform(col(vector_col), lambda e: e.cast("double"))
    bound = F.lit(float("inf"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < bound))
    whole = F.transform(x, lambda e: F.floor(e * scale).cast("double"))
    rows = vectors.filter(col(id_col).isNotNull() & (F.size(col(vector_col)) > 0) & fine)
    return rows.select(col(id_col).alias("id"), whole.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """List cells as rows, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


class Space:
    """Where the largest inner product is the least distance, with pivots and bounds.

    A candidate x gets one more component, sqrt(top - |x|^2), a query 0; then
    |q - x|^2 = |q|^2 + top - 2 q.x.
    """

    def __init__(self, pivots: np.ndarray, top: float) -> None:
        self.top, self.width = top, pivots.shape[1]
        self.pivots = self.lift(pivots)

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))
        return np.column_stack([x, more])

    def distances(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        y = self.lift(x, query)
        squares = (y * y).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * y @ self.pivots.T
        return np.sqrt(np.maximum(squares, 0))


def summaries(data: DataFrame, queries: DataFrame, space: Space, k: int) -> tuple[np.ndarray, ...]:
    """Per pivot: queries, their greatest distance to it, and the bound of their k-th neighbour.

    A task gives each cell's k least distances; the merge keeps k of each cell, so
    at most pivots * k numbers come back.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {c: np.zeros(0) for c in range(len(space.pivots))}
        for batch in batches:
            d = space.distances(matrix(batch.column(0), space.width))
            cell = d.argmin(axis=1)
            for c in np.unique(cell):
                least[c] = np.sort(np.append(least[c], d[cell == c, c]))[:k]
        rows = [(c, x) for c, values in least.items() for x in values]
        cells, d = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(d, pa.float64())], ["cell", "d"])

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = space.distances(matrix(batch.column(0), space.width), query=True)
            cell = d.argmin(axis=1)
            cells = np.unique(cell)
            n = [int((cell == c).sum()) for c in cells]
            most = [float(d[cell == c, c].max()) for c in cells]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int32()), pa.array(n, pa.int64()), pa.array(most, pa.float64())], ["cell", "n", "d"]
            )

    least = top_k(data.select("v").mapInArrow(near, "cell int, d double"), ["cell"], [F.col("d")], k, key="d")
    cells = queries.select("v").mapInArrow(far, "cell int, n long, d double").groupBy("cell")
    pivots = len(space.pivots)
    count, reach, bound = np.zeros(pivots, np.int64), np.zeros(pivots), np.full(pivots, np.inf)
    for row in cells.agg(F.sum("n").alias("n"), F.max("d").alias("d")).collect():
        count[row["cell"]], reach[row["cell"]] = row["n"], row["d"]
    rows = least.collect()
    between = np.sqrt(np.maximum(((space.pivots[:, None] - space.pivots[None]) ** 2).sum(axis=2), 0))
    for i in np.flatnonzero(count):
        upper = sorted(reach[i] + between[i, r["cell"]] + r["d"] for r in rows)
        if len(upper) >= k:
            bound[i] = upper[k - 1]
    return count, reach, bound


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to the smaller id; ``ids`` is sorted."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


def voronoi_top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
    vector_col: str = "embedding", scale: float = 256.0, pivots: int = PIVOTS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best inner products of each query row.

    Vectors are taken as floor(scale * x).  ``pivots`` rows, the first by a hash of
    their id, divide the space into cells.  From each cell's summary follows a
    distance within which the k-th neighbour of every query of a cell must lie; only
    candidates that the triangle inequality cannot place beyond it are replicated to
    the cell.  A cell is solved in blocks of queries against slices of candidates, both
    of bounded size, so one cell may hold any share of the rows; the best of the slices
    are merged in two steps.  All scores are exact below 2**53.

    Nulls: vectors that are null, empty, or hold a null or non-finite component, and
    rows without an id, take no part; shorter vectors count as filled up with zeros.
    The query's own id is no candidate.  A repeated row is a candidate by itself; a
    repeated query row is asked once.  Ties go to the smaller id.  Without rows there
    are no results; fewer than k candidates give all.
    """
    id_kind = vectors.schema[id_col].dataType.simpleString()
    data = materialize(whole_vectors(vectors, id_col, vector_col, scale))
    squares = F.aggregate("v", F.lit(0.0), lambda acc, e: acc + e * e)
    totals = data.agg(
        F.count(F.lit(1)).alias("n"), F.max(squares).alias("top"), F.max(F.size("v")).alias("width")
    ).first()
    schema = f"query_id {id_kind}, vec_id {id_kind}, score long"
    if not totals["n"]:
        empty = data.sparkSession.createDataFrame([], schema)
        return empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    queries = data.withColumnRenamed("id", id_col).filter(is_query).withColumnRenamed(id_col, "id")
    queries = queries.dropDuplicates(["id"])
    chosen = data.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    table = np.zeros((len(chosen), totals["width"]))
    for i, row in enumerate(chosen):
        table[i, :len(row["v"])] = row["v"]
    space = Space(table, totals["top"])
    # One more than k: the query's own row may be among the nearest.
    count, reach, bound = summaries(data, queries, space, k + 1)
    blocks = -(-count // BLOCK)
    parts = int(-(-totals["n"] // SLICE))
    slack = 1e-6 * (1 + float(np.sqrt(totals["top"])))
    used = np.flatnonzero(count)

    def spread(query: bool):
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for a in range(0, whole.num_rows, 1000):
                    batch = whole.slice(a, 1000)
                    d = space.distances(matrix(batch.column(1), space.width), query)
                    draw = batch.column(2).to_numpy(zero_copy_only=False)
                    if query:
                        cell = d.argmin(axis=1)
                        rows, part = np.divmod(np.arange(len(draw) * parts), parts)
                        cell, block = cell[rows], draw[rows] % blocks[cell[rows]]
                    else:
                        rows, at = np.nonzero(d[:, used] - reach[used] <= bound[used] + slack)
                        cell = used[at]
                        times = blocks[cell]
                        ends = np.cumsum(times)
                        block = np.arange(times.sum()) - np.repeat(ends - times, times)
                        rows, cell = np.repeat(rows, times), np.repeat(cell, times)
                        part = draw[rows] % parts
                    cells = [pa.array(x.astype(np.int32)) for x in (cell, block, part)]
                    picked = pa.RecordBatch.from_arrays(batch.columns[:2], ["id", "v"]).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [*cells, *picked.columns], ["cell", "block", "part", "id", "v"]
                    )

        rows = queries if query else data
        draw = F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("draw")
        made = f"cell int, block int, part int, id {id_kind}, v array<double>"
        return rows.select("id", "v", draw).mapInArrow(deal, made)

    def solve(asked: pa.Table, given: pa.Table) -> pa.Table:
        given = given.sort_by("id")
        ids, x = given["id"].to_numpy(), matrix(given["v"], space.width)
        names, q = asked["id"].to_numpy(), matrix(asked["v"], space.width)
        found = []
        for at in range(0, len(names), 100):
            scores = q[at:at + 100] @ x.T
            for name, row in zip(names[at:at + 100], scores):
                other = np.flatnonzero(ids != name)
                best = other[best_of(row[other], ids[other], k)]
                found += [(name, ids[j], int(row[j])) for j in best]
        kind = given.schema.field("id").type
        cells = zip(*found) if found else ((), (), ())
        return pa.table(dict(zip(
            ("query_id", "vec_id", "score"),
            (pa.array(c, t) for c, t in zip(cells, (kind, kind, pa.int64()))),
        )))

    key = ("cell", "block", "part")
    local = spread(True).groupBy(*key).cogroup(spread(False).groupBy(*key)).applyInArrow(solve, schema)
    order = [F.col("score").desc(), F.col("vec_id")]
    best = top_k(local, ["query_id"], order, k, key="vec_id")
    return best.select("query_id", "rank", "vec_id", "score")
