"""Fitting and judging W against numpy; embedding; storage of W."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roleatlas.catalog import views as V
from roleatlas.functions.embedding import HashedTokens, embed
from roleatlas.functions.vectors import cosine_scores, l2_normalize
from roleatlas.operators import deconfound as D
from roleatlas.operators.vector_table import upsert_vectors


@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(1)
    n, d = 200, 8
    resp = rng.normal(size=(n, d))
    role = resp @ rng.normal(size=(d, d)) * 0.5 + rng.normal(size=(n, d))
    # A third of the rows are copies of one row.
    role[: n // 3], resp[: n // 3] = role[0], resp[0]
    rows = [
        (int(i), f"c{i % 7}", f"t{i % 3}", [float(v) for v in role[i]], [float(v) for v in resp[i]]) for i in range(n)
    ]
    schema = "url_hash long, company string, title string, role_vec array<double>, resp_vec array<double>"
    return role, resp, spark.createDataFrame(rows, schema).repartition(5)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_fit(pairs):
    role, resp, df = pairs
    lam, alpha = 2.0, 0.5
    u, s, _ = np.linalg.svd(role.T @ resp)
    basis = u * (s / (s + lam))
    z = role @ basis
    expected = basis @ np.linalg.inv(z.T @ z + alpha * np.eye(8)) @ z.T @ resp
    w = D.fit_deconfound(df, lam, alpha)
    assert np.allclose(w, expected)
    raw, fitted = (D.reconstruction_r2(df, m).first()["r2"] for m in (None, w))
    assert np.isclose(fitted, 1 - ((resp - role @ w) ** 2).sum() / ((resp - resp.mean(axis=0)) ** 2).sum())
    assert fitted > raw
    assert set(D.evaluate(df, w, 5)) == {"rnp", "rrc", "ci", "r2"}


def brute_knn(x, k):
    sims = np.round(unit(x) @ unit(x).T, 10)
    np.fill_diagonal(sims, -np.inf)
    keys = np.arange(len(x))
    return [set(np.lexsort((keys, -row))[:k]) for row in sims]


@pytest.mark.parametrize("query_rows", [1000, 64])
def test_knn(pairs, query_rows):
    role, resp, df = pairs
    found = D.exact_knn(df, "role_vec", 5, query_rows=query_rows).toPandas()
    expected = brute_knn(role, 5)
    assert len(found) == 5 * len(role)
    for q, rows in found.groupby("query"):
        assert set(rows.neighbor) == expected[q]
    kept = D.knn_preservation(df, 5, query_rows=query_rows).first()
    share = np.mean([len(a & b) / 5 for a, b in zip(brute_knn(resp, 5), expected)])
    assert np.isclose(kept["rnp"], share) and kept["n_queries"] == len(role)


def test_knn_blocks_follow_cores_and_memory(pairs, monkeypatch):
    """Rows are sent once to each block, so blocks grow with the table before their number does."""
    role, _, df = pairs
    monkeypatch.setattr(D, "QUERY_ROWS", 10)
    found = D.exact_knn(df, "role_vec", 5)
    cores = df.sparkSession.sparkContext.defaultParallelism
    blocks = D.block_count(len(role), role.shape[1], cores)
    assert 1 < blocks < len(role) // 10 and blocks * (blocks + 1) // 2 >= 3 * cores
    assert f"sequence(0, {blocks - 1}" in found._jdf.queryExecution().toString()
    expected = brute_knn(role, 5)
    assert {q: set(rows.neighbor) for q, rows in found.toPandas().groupby("query")} == dict(enumerate(expected))
    monkeypatch.undo()
    assert D.block_count(580_000, 64, 12) == D.block_count(58_000, 64, 12) == 9
    assert D.block_count(0, 64, 12) == 1 and D.block_count(100_000, 4096, 12) == 25


def test_folds_find_what_is_nearest_by_the_target_once(pairs, monkeypatch):
    _, _, df = pairs
    asked, exact_knn = [], D.exact_knn

    def counted(vectors, column, *args, **more):
        asked.append(column)
        return exact_knn(vectors, column, *args, **more)

    monkeypatch.setattr(D, "exact_knn", counted)
    found = {r["fold"]: r for r in D.cross_validate(df, 2, 2.0, 0.5, 5).collect()}
    assert asked.count("resp_vec") == len(found) and len(asked) == 3 * len(found)
    for fold, row in found.items():
        held = D.company_folds(df, 2).filter(F.col("fold") == fold)
        assert np.isclose(row["raw_rnp"], D.knn_preservation(held, 5).first()["rnp"])


def test_rank_correlation_with_ties(pairs):
    role, resp, df = pairs
    df, n = df.filter("url_hash < 199"), 199
    got = D.rank_correlation(df).first()
    keys = sorted(range(n), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    picks = [(keys[k], keys[k + 1]) for k in range(0, n - 1, 2)] + [(keys[-1], keys[-2])]
    assert {i for pick in picks for i in pick} == set(range(n))
    sims = pd.DataFrame([
        (round(float(unit(role)[a] @ unit(role)[b]), 9), round(float(unit(resp)[a] @ unit(resp)[b]), 9)) for a, b in picks
    ])
    ranks = sims.rank()
    assert got["n_pairs"] == len(picks)
    assert np.isclose(got["rrc"], np.corrcoef(ranks[0], ranks[1])[0, 1])


def test_company_invariance(pairs):
    role, _, df = pairs
    u = unit(role)
    sims = [u[a] @ u[b] for a in range(200) for b in range(a) if a % 3 == b % 3 and a % 7 != b % 7]
    got = D.company_invariance(df).first()
    assert got["n_pairs"] == len(sims) and np.isclose(got["ci"], np.mean(sims))
    alone = df.withColumn("company", F.lit("one"))
    assert D.company_invariance(alone).first()["ci"] is None


def test_folds_keep_companies_together(spark, sf):
    folds = D.company_folds(V.role_listings(spark, sf), 3)
    assert folds.groupBy("company").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0


def test_stored_transform(spark, tmp_path):
    w = np.arange(9.0).reshape(3, 3)
    D.save_transform(spark, w, str(tmp_path / "w"))
    assert np.array_equal(D.load_transform(spark, str(tmp_path / "w")), w)
    assert D.load_transform(spark, str(tmp_path / "none")) is None
    assert D.load_transform(spark, str(tmp_path / "none.npz")) is None
    np.savez(tmp_path / "w.npz", W=w, version=1)
    np.savez(tmp_path / "v.npz", V=w)
    assert np.array_equal(D.load_transform(spark, str(tmp_path / "w.npz")), w)
    assert D.load_transform(spark, str(tmp_path / "v.npz")) is None


def test_vectors_must_agree(spark):
    ragged = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "url_hash long, v array<double>").coalesce(1)
    with pytest.raises(Exception, match="one dimension"):
        l2_normalize(ragged, "v", "u").collect()
    zero = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0])], "url_hash long, v array<double>")
    plain = l2_normalize(zero, "v", "u", epsilon=0).orderBy("url_hash").collect()
    assert np.allclose([r["u"] for r in plain], [[0.0, 0.0], [0.6, 0.8]])
    scored = cosine_scores(zero, [[1.0, 0.0], [0.0, -2.0]], "v").orderBy("url_hash").collect()
    assert np.allclose([r["scores"] for r in scored], [[0.0, 0.0], [0.6, -0.8]])


def test_embed(spark):
    texts = spark.range(25).select(F.col("id").alias("url_hash"), F.lit("some text here").alias("text")).coalesce(1)

    def sized(texts):
        return np.array([[float(len(texts)), 1.0]] * len(texts))

    def short(texts):
        return np.zeros((len(texts) - 1, 2))

    calls = [r["role_vec"][0] / r["role_vec"][1] for r in embed(texts, sized, batch=10).collect()]
    assert [round(c) for c in calls] == [10] * 20 + [5] * 5
    with pytest.raises(Exception, match="one vector per text"):
        embed(texts, short, batch=10).collect()
    blank = texts.withColumn("text", F.lit(" x "))
    named = texts.withColumn("text", F.lit("untitled position"))
    assert embed(blank, HashedTokens(16)).first()["role_vec"] == embed(named, HashedTokens(16)).first()["role_vec"]
    assert np.isclose(np.linalg.norm(embed(texts).first()["role_vec"]), 1, atol=1e-5)


def test_upsert_vectors(spark):
    schema = "url_hash long, role_vec array<float>"
    old = spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)
    new = spark.createDataFrame([(2, [20.0], 0), (2, [21.0], 1), (3, [3.0], 0)], schema + ", seq int")
    assert sorted((r[0], r[1][0]) for r in upsert_vectors(old, new).collect()) == [(1, 1.0), (2, 21.0), (3, 3.0)]
