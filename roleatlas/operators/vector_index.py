"""A stored inverted file for small-k retrieval, which reads only the nearest cells.

Unit vectors are dealt to trained cells, one partition of the table per cell.  How many
cells a search reads is measured when the index is built, so that a wanted recall is
reached; exact prefetches remain the way to get wide or complete results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import SCORE_DIGITS, matrix, normalize
from ..session import scratch_path

# Bounds of what reaches the driver: vectors to train cells on, and queries to measure recall with.
TRAIN_ROWS, MEASURE_ROWS = 20_000, 200
MOST_CELLS = 4096
ROUNDS = 8


def sample_rows(vectors: DataFrame, rows: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``rows`` keys and unit vectors, the same ones however data is laid out."""
    order = F.xxhash64(F.col("url_hash"), F.lit(salt))
    table = vectors.select("url_hash", "role_vec").orderBy(order, "url_hash").limit(rows).toArrow()
    if not table.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, 1))
    return table["url_hash"].to_numpy(), normalize(matrix(table["role_vec"]))


def train_cells(unit: np.ndarray, cells: int, seed: int) -> np.ndarray:
    """Spherical k-means; a cell that loses all its vectors stays where it was."""
    rng = np.random.default_rng(seed)
    centers = unit[rng.permutation(len(unit))[:cells]].copy()
    for _ in range(ROUNDS):
        nearest = (unit @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, unit)
        some = np.linalg.norm(sums, axis=1) > 0
        centers[some] = normalize(sums[some])
    return centers


def best_rows(
    rows: DataFrame, queries: np.ndarray, keys: np.ndarray, k: int, probes: list[set[int]] | None = None
) -> DataFrame:
    """``query, url_hash, cell, sim, rank``: each query's k best rows, its own key left out.

    ``queries`` are unit vectors.  Tasks give their own best; with ``probes``, a query is
    compared with rows of its cells alone.
    """
    shared = rows.sparkSession.sparkContext.broadcast((queries, keys, probes))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, own, wanted = shared.value
        held = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked]
        for batch in batches:
            if not batch.num_rows:
                continue
            key, cell = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sims = np.round(normalize(matrix(batch.column(2))) @ asked.T, SCORE_DIGITS)
            for q in range(len(asked)):
                at = key != own[q]
                if wanted is not None:
                    at &= np.isin(cell, list(wanted[q]))
                score, name, place = (np.append(h, x[at]) for h, x in zip(held[q], (sims[:, q], key, cell)))
                order = np.lexsort((name, -score))[:k]
                held[q] = score[order], name[order], place[order]
        sizes = [len(h[0]) for h in held]
        if sum(sizes):
            score, name, place = (np.concatenate([h[c] for h in held]) for c in range(3))
            query = np.repeat(own, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (query, name, place.astype(np.int32), score)], ["query", "url_hash", "cell", "sim"]
            )

    found = rows.select("url_hash", "cell", "role_vec").mapInArrow(
        pick, "query long, url_hash long, cell int, sim double"
    )
    order = Window.partitionBy("query").orderBy(F.col("sim").desc(), "url_hash")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@dataclass
class VectorIndex:
    """Cells' centers, the folder of the rows and how many cells a search reads."""

    centers: np.ndarray
    path: str
    probes: int

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """Per unit vector its nearest cells, as many as a search reads."""
        return np.argsort(-(unit @ self.centers.T), axis=1, kind="stable")[:, :self.probes]

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("url_hash long, role_vec array<float>, cell int").parquet(f"{self.path}/rows")

    def search(self, spark: SparkSession, keys: np.ndarray, vectors: np.ndarray, k: int) -> DataFrame:
        """The k nearest rows of each query but its own key, read from its nearest cells alone.

        Queries are few, as they are held on the driver.
        """
        unit = normalize(np.asarray(vectors, dtype=np.float64))
        near = self.cells(unit)
        wanted = self.rows(spark).filter(F.col("cell").isin([int(c) for c in np.unique(near)]))
        return best_rows(wanted, unit, np.asarray(keys, np.int64), k, [set(r.tolist()) for r in near])

    def save(self, spark: SparkSession) -> None:
        rows = [(i, c.tolist(), self.probes) for i, c in enumerate(self.centers)]
        frame = spark.createDataFrame(rows, "cell int, center array<double>, probes int")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/cells")


def load_index(spark: SparkSession, path: str) -> VectorIndex:
    table = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    return VectorIndex(np.array([r["center"] for r in table]), path, table[0]["probes"])


def build_index(
    vectors: DataFrame, path: str, cells: int | None = None, recall: float = 0.95, k: int = 10, seed: int = 42
) -> VectorIndex:
    """Deal all ``vectors`` (``url_hash, role_vec``) to cells below ``path``.

    Cells, the square root of the rows unless given, are trained on at most TRAIN_ROWS
    vectors.  For MEASURE_ROWS stored vectors the k nearest are found exactly, and a search
    reads so many cells that it meets ``recall`` of these.
    """
    spark = vectors.sparkSession
    n = vectors.count()
    cells = max(1, min(int(n**0.5) if cells is None else cells, MOST_CELLS, max(n, 1)))
    _, unit = sample_rows(vectors, TRAIN_ROWS, seed)
    centers = train_cells(unit, cells, seed) if len(unit) else np.zeros((1, 1))
    shared = spark.sparkContext.broadcast(centers)

    def nearest(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.int32())
        return pa.array((normalize(matrix(column)) @ shared.value.T).argmax(axis=1).astype(np.int32))

    dealt = vectors.select("url_hash", "role_vec", F.arrow_udf(nearest, "int")("role_vec").alias("cell"))
    # By range of both, so that a cell of very many rows is split over tasks.
    dealt = dealt.repartitionByRange("cell", "url_hash")
    dealt.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    index = VectorIndex(centers, path, len(centers))
    keys, asked = sample_rows(vectors, MEASURE_ROWS, seed + 1)
    if len(keys):
        found = best_rows(index.rows(spark), asked, keys, k).select("query", "cell").toArrow()
        order = np.argsort(-(asked @ centers.T), axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(len(centers))[None, :], axis=1)
        row_of = {int(key): i for i, key in enumerate(keys)}
        ranks = [place[row_of[q], c] for q, c in zip(found["query"].to_pylist(), found["cell"].to_pylist())]
        if ranks:
            index.probes = int(np.quantile(ranks, recall, method="higher")) + 1
    index.save(spark)
    return index


def approx_knn(vectors: DataFrame, query: np.ndarray, k: int) -> DataFrame:
    """About the k nearest rows to one query vector, from an index made for it.

    Keep an index with :func:`build_index` to search more than once.
    """
    spark = vectors.sparkSession
    index = build_index(vectors, scratch_path(spark, "index"), k=k)
    # No row has this key, so none is left out.
    found = index.search(spark, np.array([np.iinfo(np.int64).min]), np.asarray(query)[None, :], k)
    return found.select("url_hash", "sim")


__all__ = ["VectorIndex", "approx_knn", "best_rows", "build_index", "load_index", "train_cells"]
