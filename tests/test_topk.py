"""Exact selection against brute force, with a third of the rows tied."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roleatlas.operators.topk import cut_at_rank, global_rank, top_k
from roleatlas.session import fits_broadcast, hot_keys, lookup_join, salted_join


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(7)
    rows = []
    for role in ("a", "b", "c"):
        n = {"a": 3000, "b": 900, "c": 5}[role]
        values = np.round(rng.uniform(-1, 1, n), 3)
        values[: n // 3] = 0.25
        keys = rng.permutation(n)
        rows += [(role, int(k), float(v)) for k, v in zip(keys, values)]
    pdf = pd.DataFrame(rows, columns=["role", "url_hash", "score"])
    return pdf, spark.createDataFrame(pdf).repartition(7)


def brute(pdf, widths):
    ordered = pdf.sort_values(["role", "score", "url_hash"], ascending=[True, False, True])
    ordered["place"] = ordered.groupby("role").cumcount() + 1
    kept = ordered[ordered.place <= ordered.role.map(widths)]
    return sorted(zip(kept.role, kept.url_hash))


@pytest.mark.parametrize("window_rows", [10**6, 0])
@pytest.mark.parametrize("widths", [
    {"a": 1, "b": 1, "c": 1}, {"a": 1000, "b": 400, "c": 5}, {"a": 1500, "b": 10**6, "c": 3},
    {"a": 3000, "b": 900, "c": 5}, {"a": 10**6, "b": 10**6, "c": 10**6},
])
def test_cut_at_rank(scores, widths, window_rows):
    pdf, df = scores
    got = cut_at_rank(df, "role", "score", "url_hash", widths, window_rows=window_rows)
    assert sorted((r.role, r.url_hash) for r in got.select("role", "url_hash").collect()) == brute(pdf, widths)
    assert got.columns == df.columns


@pytest.mark.parametrize("bounded", [True, False])
def test_top_k(scores, bounded):
    pdf, df = scores
    got = top_k(df, ["role"], [F.col("score").desc(), F.col("url_hash")], 50, bounded=bounded)
    assert sorted((r.role, r.url_hash) for r in got.collect()) == brute(pdf, {"a": 50, "b": 50, "c": 50})
    assert {r["m"] for r in got.groupBy("role").agg((F.max("rank") - F.count("*")).alias("m")).collect()} == {0}


@pytest.mark.parametrize("slices", [1, 5])
def test_global_rank(scores, slices):
    pdf, df = scores
    got = global_rank(df, [F.col("score").desc(), F.col("role"), F.col("url_hash")], "place", slices=slices).toPandas()
    ordered = got.sort_values(["score", "role", "url_hash"], ascending=[False, True, True])
    assert list(ordered.place) == list(range(1, len(pdf) + 1))


def test_weighted_rank(spark):
    df = spark.createDataFrame([(10, 2), (20, 3), (30, 1)], "v int, n long")
    got = global_rank(df, [F.col("v")], "first", weight=F.col("n"), slices=2)
    assert sorted((r.v, r["first"]) for r in got.collect()) == [(10, 1), (20, 3), (30, 6)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_has_two_equal_ways(spark, how):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id"
    )
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("zz", 3)], "k string, x int")
    assert fits_broadcast(lookup) and not fits_broadcast(lookup, limit=10)
    small = lookup_join(rows, lookup, ["k"], how)
    large = lookup_join(rows, lookup, ["k"], how, limit=10, salts=8)
    assert sorted(small.collect(), key=repr) == sorted(large.collect(), key=repr)


def test_only_hot_keys_are_salted(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id"
    )
    lookup = rows.select("k").distinct().withColumn("x", F.lit(1))
    hot = hot_keys(rows, ["k"], 8)
    assert [r["k"] for r in hot] == ["hot"] and hot_keys(rows.filter("k <> 'hot'"), ["k"], 8) == []
    assert salted_join(rows, lookup, ["k"], "inner", 8, hot).count() == 3000
    plain = lookup_join(rows.filter("k <> 'hot'"), lookup, ["k"], "inner", limit=10)
    assert "_salt" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_cut_of_width_zero_keeps_nothing(spark):
    rows = spark.createDataFrame([("a", 0.5, 1), ("a", 0.4, 2), ("b", 0.3, 3)], "g string, s double, url_hash long")
    kept = cut_at_rank(rows, "g", "s", "url_hash", {"a": 1, "b": 0})
    assert [r["url_hash"] for r in kept.collect()] == [1]
    assert cut_at_rank(rows, "g", "s", "url_hash", {"a": 0, "b": 0}).count() == 0


def test_salting_spreads_a_hot_key(spark):
    rows = spark.range(3000).select(F.lit("hot").alias("k"), "id")
    salt = F.pmod(F.xxhash64("k", "id"), F.lit(8))
    sizes = [r["count"] for r in rows.groupBy(salt).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 500
