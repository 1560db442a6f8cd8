"""Key filters at the scan and cuts of score arrays, against plain numpy and plans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roleatlas.catalog import views as V
from roleatlas.operators import key_filter as K
from roleatlas.operators import wide_scores as W
from roleatlas.operators.topk import BINS, cut_at_rank
from roleatlas.plans.neighborhood import BUILTIN_ROLES, find_center, find_centroids

ROLES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def scores():
    rng = np.random.default_rng(3)
    raw = np.round(rng.uniform(-1, 1, (900, 3)), 3)
    # A third of one role's listings tie on one score; others sit on the ends.
    raw[::3, 1] = 0.25
    raw[:4, 2] = [1.0, -1.0, 1.0, -1.0]
    return raw


@pytest.fixture(scope="module")
def wide(spark, scores):
    rows = [(k, ["a"] if k % 10 == 0 else [], k % 4 > 0, r.tolist(), (-r).tolist()) for k, r in enumerate(scores)]
    schema = "url_hash long, center_of array<string>, plain boolean, raw_scores array<double>, clean_scores array<double>"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


@pytest.mark.parametrize("widths", [[10, 200, 900], [0, 1, 2000], [300, 301, 1]])
def test_rows_above_hold_the_first(wide, scores, widths):
    wanted = dict(zip(ROLES, widths))
    above = W.above_cut(wide, ROLES, wanted)
    got = cut_at_rank(above, "role", "raw_score", "url_hash", wanted).collect()
    for k, role in enumerate(ROLES):
        order = np.lexsort((np.arange(900), -scores[:, k]))[:wanted[role]]
        mine = [r for r in got if r["role"] == role]
        assert sorted(r["url_hash"] for r in mine) == sorted(order.tolist())
        for r in mine:
            assert r["clean_score"] == -r["raw_score"] == -scores[r["url_hash"], k]
            assert r["center_of"] == (["a"] if r["url_hash"] % 10 == 0 else [])
    assert above.count() <= sum(min(900, w) for w in widths) + 900


def test_histogram(wide, scores):
    found = W.histograms(wide, ROLES)
    assert found.shape == (3, BINS + 1) and found.sum(axis=1).tolist() == [900] * 3
    assert found[2, 0] >= 2 and found[2, BINS] >= 2


@pytest.mark.parametrize("held", [4096, 8])
def test_lowest(wide, scores, held, monkeypatch):
    monkeypatch.setattr(W, "HELD", held)
    got = W.lowest(wide, ROLES, 20).collect()
    plain = np.array([k for k in range(900) if k % 4 > 0])
    for k, role in enumerate(ROLES):
        order = plain[np.lexsort((plain, scores[plain, k]))][:20]
        mine = sorted((r["raw_score"], r["url_hash"]) for r in got if r["role"] == role)[:20]
        assert [key for _, key in mine] == order.tolist()
    assert len(got) <= 5 * 3 * 20 or held == 8


def test_nothing_to_cut(spark, wide):
    none = wide.limit(0)
    assert not W.above_cut(none, ROLES, dict.fromkeys(ROLES, 5)).collect() and not W.lowest(none, ROLES, 5).collect()


@pytest.mark.parametrize("most", [K.MOST_BITS, 13])
def test_filter_keeps_every_key(spark, most):
    """Also one that is far too small: it lets more pass, and never less."""
    rng = np.random.default_rng(4)
    keys = rng.integers(-(2**63), 2**63 - 1, 5000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "url_hash long").repartition(3)
    found = K.key_filter(frame, "url_hash", most)
    assert found.passes(keys).all()
    others = rng.integers(-(2**63), 2**63 - 1, 20_000)
    share = found.passes(others).mean()
    assert share < 0.01 if most == K.MOST_BITS else share <= 1
    table = spark.createDataFrame([(int(k), i) for i, k in enumerate([*keys[:50], *others[:500]])], "url_hash long, i int")
    assert sorted(r["i"] for r in K.join_keys(table, frame).collect()) == list(range(50))


def test_vectors_are_not_exchanged(spark, sf, tmp_path):
    """Below the filter the vectors' scan has no exchange, and centroids do not change with the join."""
    v2 = V.role_listings(spark, sf)
    V.vectors_of(v2).write.parquet(str(tmp_path / "vectors"))
    vectors = spark.read.parquet(str(tmp_path / "vectors"))
    center = find_center(V.listings_of(v2), BUILTIN_ROLES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = center.select("url_hash", "role")
        joined = K.join_keys(vectors, keys)
        text = joined._jdf.queryExecution().executedPlan().toString()
        side = text[:text.index("vectors")].rsplit("Exchange", 1)[1]
        assert "ArrowEvalPython" in side and "Exchange" not in side
        once = {(r["role"], r["n"]) for r in find_centroids(center, vectors).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    counts = vectors.join(center, "url_hash").groupBy("role").agg(F.count("*").alias("n")).collect()
    assert once == {(r["role"], r["n"]) for r in counts}
