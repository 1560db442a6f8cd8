"""Physical plans: what must be pushed down, and what must not appear."""

import json

import pytest
from pyspark.sql import functions as F

from roleatlas.catalog import views as V
from roleatlas.functions.vectors import cosine_scores
from roleatlas.operators import state as ST
from roleatlas.operators.vector_table import searchable
from roleatlas.plans.ingest import run_ingest
from roleatlas.plans.neighborhood import BUILTIN_ROLES, find_center, find_neighborhood
from roleatlas.session import materialize, shared_dir
from roleatlas.sources import snapshots
from roleatlas.streaming import landed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("state"))
    return snapshots.read_listings(spark, snapshots.write_snapshot(V.prior_state(spark, sf), root, 0))


def test_active_titled_scan_prunes(stored):
    text = plan(find_center(stored, BUILTIN_ROLES))
    assert "description_raw" not in text
    assert "PartitionFilters: [isnotnull(is_active" in text and "PushedFilters: [IsNotNull(title), Not(EqualTo(title,))" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_row_at_a_time_python(spark, sf, stored):
    run = run_ingest(stored, V.scraped_batch(spark, sf), V.fetch_log(spark, sf), V.RUN_START)
    text = plan(run.listings)
    assert "BatchEvalPython" not in text and "Cartesian" not in text and "NestedLoop" not in text
    # The digest is taken of the batch, below the join with the stored table.
    assert text.count("ArrowEvalPython") == 1
    assert text.index("ArrowEvalPython") > text.index("FullOuter")
    assert text.count("FullOuter") == 1


def test_last_values_hash_numbers_before_the_shuffle(spark, sf, monkeypatch):
    """Winners are found by numbers in hash aggregates; nothing sorts or gathers text."""
    written = []

    def keep(df):
        written.append(plan(df))
        return materialize(df)

    monkeypatch.setattr(ST, "materialize", keep)
    merged = ST.upsert_listings(V.prior_state(spark, sf), V.scraped_batch(spark, sf), V.RUN_START)
    plans = [*written, plan(merged)]
    winners = next(p for p in plans if "partial_max_by" in p)
    assert "HashAggregate" in winners and winners.count("Exchange hashpartitioning") == 1
    assert "description_raw" not in winners.split("ReadSchema")[1].replace("_gives_description_raw", "")
    assert not any("SortAggregate" in p for p in plans)


def test_descriptions_move_in_one_join_only(spark, sf, monkeypatch):
    """What other rows of a key give is found without descriptions, also where nothing is broadcast."""
    written = []

    def keep(df):
        written.append(plan(df))
        return materialize(df)

    rows = [("u", "c", 1, "T", "", "x", "", ""), ("u", "c", 2, "", "long", "", "", ""), ("v", "c", 1, "V", "", "", "", "")]
    names = "url string, company string, seq long, title string, description_raw string, location string"
    batch = spark.createDataFrame(rows, names + ", remote_onsite string, posted_date string")
    batch = batch.withColumn("source_domain", F.lit("ats"))
    monkeypatch.setattr(ST, "materialize", keep)
    found = ST.last_values(batch).collect()
    assert {r["url"]: (r["title"], r["description_raw"], r["location"]) for r in found} == {
        "u": ("T", "long", "x"), "v": ("V", "", "")}
    reads = [p.replace("_gives_description_raw", "").replace("_description_raw", "") for p in written[1:]]
    assert len(reads) > 2 and not any("description_raw" in p for p in reads)


def test_bucketed_tables_join_without_exchange(spark, sf):
    v2 = V.role_listings(spark, sf)
    for name, df in (("listings_b", V.listings_of(v2)), ("vectors_b", V.vectors_of(v2))):
        snapshots.save_bucketed(df, name, "url_hash", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = searchable(spark.table("listings_b"), spark.table("vectors_b"))
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert joined.count() == searchable(V.listings_of(v2), V.vectors_of(v2)).count()
        # Scored after the join, the pass over the vectors has no exchange at all.
        text = plan(cosine_scores(joined, [[1.0] * 64]))
        assert "ArrowEvalPython" in text and "Exchange" not in text
        settings = {"roles": BUILTIN_ROLES[:2], "n": 20, "prefetch_extra": 0}
        one = find_neighborhood(spark.table("listings_b"), spark.table("vectors_b"), co_located=True, **settings)
        two = find_neighborhood(V.listings_of(v2), V.vectors_of(v2), **settings)
        assert sorted(one.neighbors.collect()) == sorted(two.neighbors.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_replayed_stream_batch_changes_nothing(spark, sf, tmp_path):
    source, root = str(tmp_path / "landed"), str(tmp_path / "versions")
    rows = V.scraped_batch(spark, sf).drop("doc_id")
    state = V.prior_state(spark, sf)
    half = F.col("url").contains("1?")
    rows.filter(half).coalesce(1).write.parquet(source)

    def run():
        query = landed.stream_upserts(
            spark, source, root, str(tmp_path / "offsets"), state, V.RUN_START, schema=rows.schema)
        query.awaitTermination()
        return sorted(snapshots.read_listings(spark, landed.latest_version(spark, root)).collect(), key=repr)

    first = run()
    rows.filter(~half).coalesce(1).write.mode("append").parquet(source)
    second = run()
    assert landed.latest_version(spark, root).endswith("version=1") and first != second
    # Forget that the last batch was committed, as after a lost driver.
    commits = tmp_path / "offsets" / "commits"
    kept = {p.name: p.read_bytes() for p in commits.iterdir()}
    assert "1" in kept and json.loads(kept["1"].decode().splitlines()[1]) is not None
    replay = tmp_path / "replayed"
    import shutil

    shutil.copytree(tmp_path / "offsets", replay, ignore=lambda d, names: [n for n in names if d.endswith("commits") and n.lstrip(".").startswith("1")])
    query = landed.stream_upserts(spark, source, root, str(replay), state, V.RUN_START, schema=rows.schema)
    query.awaitTermination()
    again = sorted(snapshots.read_listings(spark, landed.latest_version(spark, root)).collect(), key=repr)
    assert again == second
