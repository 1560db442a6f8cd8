"""Chunked encoding, the stored index and the held-out protocol."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roleatlas import schemas
from roleatlas.catalog import views as V
from roleatlas.catalog.text_queries import stored_vectors
from roleatlas.functions.embedding import HashedTokens
from roleatlas.operators import deconfound as D
from roleatlas.operators import vector_index as I
from roleatlas.operators import vector_table
from roleatlas.plans.encode import encode_in_chunks, encode_new, finished_vectors, pending_texts


def breaks(ending):
    """An embedder that gives up on some texts, as a service that is cut off."""

    def call(texts):
        if any(len(t) % 97 in ending for t in texts):
            raise ConnectionError("no answer")
        return np.ones((len(texts), 4))

    return call


def marks():
    def call(texts):
        return np.tile([0.0, 0.0, 0.0, 1.0], (len(texts), 1))

    return call


@pytest.fixture(scope="module")
def state(spark, sf):
    return V.prior_state(spark, sf).cache()


def test_finished_chunks_survive_a_failing_embedder(spark, sf, state, tmp_path):
    stored, folder = stored_vectors(spark, sf), str(tmp_path / "chunks")
    pending = pending_texts(state, stored).cache()
    n = pending.count()
    chunks = 5
    rows = -(-n // chunks)
    chunks = -(-n // rows)
    share = F.pmod(F.xxhash64("url_hash"), F.lit(chunks))
    lengths = {r[0]: set(r[1]) for r in pending.groupBy(share).agg(F.collect_set(F.length("text") % 97)).collect()}
    first = set().union(*(lengths.get(c, set()) for c in range(chunks - 1)))
    only_last = lengths[chunks - 1] - first
    assert only_last, "the last chunk needs a text of its own length"
    with pytest.raises(Exception, match="no answer"):
        encode_in_chunks(state, stored, folder, breaks(only_last), chunk_rows=rows)
    kept = finished_vectors(spark, folder).count()
    assert 0 < kept < n
    # What is missing is embedded by another embedder, so that the two can be told apart.
    encoded = encode_in_chunks(state, stored, folder, marks(), chunk_rows=rows)
    new = finished_vectors(spark, folder)
    assert new.filter(F.get("role_vec", 0) > 0).count() == kept and new.count() == n
    assert encoded.count() == stored.count() + n == encoded.select("url_hash").distinct().count()
    assert pending_texts(state, encoded).count() == 0
    assert encode_in_chunks(state, stored, folder, breaks(set(range(97)))).count() == encoded.count()


def test_chunks_give_what_one_pass_gives(spark, sf, state, tmp_path):
    stored = stored_vectors(spark, sf)
    one = encode_new(state, stored, HashedTokens(8), compact=False)
    several = encode_in_chunks(state, stored, str(tmp_path / "c"), HashedTokens(8), chunk_rows=3)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, several.collect()))


@pytest.mark.parametrize("few", [0, 10, 10**9])
def test_pending_by_either_way(spark, sf, state, few, monkeypatch):
    monkeypatch.setattr(vector_table, "FEW", few)
    found = vector_table.unembedded(state, stored_vectors(spark, sf))
    keys = {r["url_hash"] for r in found.collect()}
    have = {r["url_hash"] for r in stored_vectors(spark, sf).select("url_hash").collect()}
    wanted = {
        r["url_hash"] for r in state.collect()
        if r["is_active"] and r["url_hash"] not in have and (r["title"] or len(r["description_raw"]) > 50)
    }
    assert keys == wanted


def clustered(spark, groups=40, each=25, d=16):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(groups, d))
    points = np.repeat(centers, each, axis=0) + rng.normal(scale=0.05, size=(groups * each, d))
    rows = [(k, p.astype(float).tolist()) for k, p in enumerate(points)]
    return points, spark.createDataFrame(rows, schemas.VECTORS)


def test_index_reads_few_cells_and_finds(spark, tmp_path):
    points, vectors = clustered(spark)
    I.build_index(vectors, str(tmp_path / "i"), cells=30)
    index = I.load_index(spark, str(tmp_path / "i"))
    assert index.probes < 10 and len(index.centers) == 30
    asked = np.arange(0, 1000, 50)
    found = index.search(spark, asked, points[asked], 10).collect()
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    sims = unit[asked] @ unit.T
    sims[np.arange(len(asked)), asked] = -2
    true = {(int(q), int(k)) for q, row in zip(asked, sims) for k in np.argsort(-row)[:10]}
    assert len({(r["query"], r["url_hash"]) for r in found} & true) >= 0.9 * len(true)
    assert all(r["query"] != r["url_hash"] for r in found)
    one = index.search(spark, asked[:1], points[asked[:1]], 3)
    cells = set(index.cells(unit[asked[:1]])[0].tolist())
    assert {r["cell"] for r in one.collect()} <= cells
    # The cells are whole partitions, and others are not even listed.
    assert re.search(r"PartitionFilters: \[[^\]]*cell", one._jdf.queryExecution().executedPlan().toString())
    read = index.rows(spark).filter(F.col("cell").isin(list(cells))).select(F.input_file_name().alias("f")).distinct()
    assert {r["f"].split("cell=")[1].split("/")[0] for r in read.collect()} <= {str(c) for c in cells}
    assert len(cells) == index.probes


def test_index_of_one_vector_and_of_none(spark, tmp_path):
    vectors = spark.createDataFrame([(5, [1.0, 0.0])], schemas.VECTORS)
    index = I.build_index(vectors, str(tmp_path / "one"))
    assert [r["url_hash"] for r in index.search(spark, np.array([9]), np.array([[0.5, 0.5]]), 3).collect()] == [5]
    assert index.search(spark, np.array([5]), np.array([[0.5, 0.5]]), 3).collect() == []


def test_fold_sums_leave_out_their_own(spark, sf):
    pairs = V.vector_pairs(spark, sf)
    folds = D.company_folds(pairs, 3).cache()
    xx, xy = D.fold_gram_sums(folds, 3)
    for fold in range(3):
        others = folds.filter(F.col("fold") != fold)
        if xx[fold].any() and others.count():
            own_xx, own_xy = D.gram_sums(others)
            assert np.allclose(xx.sum(axis=0) - xx[fold], own_xx) and np.allclose(xy.sum(axis=0) - xy[fold], own_xy)


def test_cross_validation_equals_its_parts(spark, sf):
    pairs = V.vector_pairs(spark, sf)
    found = D.cross_validate(pairs, 2, neighbors=5).collect()
    folds = D.company_folds(pairs, 2)
    assert sum(r["n"] for r in found) == pairs.count()
    r = found[0]
    held = folds.filter(F.col("fold") == r["fold"])
    w = D.fit_deconfound(folds.filter(F.col("fold") != r["fold"]), 1.0, 1e-3)
    assert np.isclose(r["clean_r2"], D.reconstruction_r2(held, w).first()["r2"])
    assert np.isclose(r["raw_r2"], D.reconstruction_r2(held).first()["r2"])
    assert r["clean_r2"] > r["raw_r2"]


def test_orphans_leave_other_files_alone(spark, tmp_path):
    """Only buckets with orphans are written again, and one of orphans alone goes away."""
    path = str(tmp_path / "vectors")
    vectors = spark.createDataFrame([(k, [float(k)]) for k in range(300)], schemas.VECTORS)
    vector_table.write_buckets(vectors, path, 32)

    def files():
        rows = vector_table.read_buckets(spark, path).select("bucket", F.col("_metadata.file_path").alias("f"))
        return {r["bucket"]: r["f"] for r in rows.distinct().collect()}

    names = files()
    of_bucket = {}
    for r in vector_table.read_buckets(spark, path).collect():
        of_bucket.setdefault(r["bucket"], set()).add(r["url_hash"])
    some, whole, *_ = sorted(of_bucket)
    gone = {min(of_bucket[some])} | of_bucket[whole]
    listings = spark.createDataFrame([(k, k not in gone) for k in range(300)], "url_hash long, is_active boolean")
    assert vector_table.drop_orphans(listings, path) == {"orphaned": len(gone), "rewritten": 2}
    left = vector_table.read_buckets(spark, path)
    assert {r["url_hash"] for r in left.collect()} == set(range(300)) - gone
    after = files()
    assert whole not in after and after[some] != names[some]
    assert all(after[b] == names[b] for b in after if b != some)
    assert vector_table.drop_orphans(listings, path) == {"orphaned": 0, "rewritten": 0}
