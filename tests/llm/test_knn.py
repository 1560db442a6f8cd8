"""Voronoi join against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roleatlas.llm import knn_join


def brute(rows, asked, k):
    good = [(i, np.floor(256 * np.array(v, float))) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, np.append(v, np.zeros(width - len(v)))) for i, v in good]
    out = []
    for q, v in {i: v for i, v in good if asked(i)}.items():
        best = sorted((-int(v @ x), i) for i, x in good if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block, part, pivots", [(1000, 8000, 16), (3, 20, 4)])
def test_brute(spark, monkeypatch, block, part, pivots):
    monkeypatch.setattr(knn_join, "BLOCK", block)
    monkeypatch.setattr(knn_join, "SLICE", part)
    rng = random.Random(0)
    centers = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centers)]) for i in range(200)]
    rows += [(200 + i, [0.5] * 6) for i in range(60)]  # many equal ones
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6),
             (304, [float("inf")] * 6), (305, [2.0, 1.0]), (None, [1.0] * 6), (306, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).repartition(4)
    got = knn_join.voronoi_top_k(df, F.col("vec_id") % 5 == 0, pivots=pivots)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 5 == 0, 5)


def test_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    ask = lambda rows: sorted(map(tuple, knn_join.voronoi_top_k(
        spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).collect()))
    assert ask([]) == [] and ask([(0, [1.0])]) == [] and ask([(1, [1.0]), (2, [1.0])]) == []
    assert ask([(0, [1.0]), (1, [0.5]), (2, [0.5])]) == [(0, 1, 1, 32768), (0, 2, 2, 32768)]
    assert ask([(0, [1.0]), (0, [1.0]), (1, [0.5])]) == [(0, 1, 1, 32768)]
