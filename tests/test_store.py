"""The store of versions: what a pass reads, moves and writes, and what a replay gives."""

import datetime as dt
import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roleatlas import schemas
from roleatlas.catalog import table_queries as T
from roleatlas.catalog import views as V
from roleatlas.catalog.table_queries import follow, land_fetches, second_batch
from roleatlas.operators import state as ST
from roleatlas.plans.ingest import ingest_version, run_ingest
from roleatlas.session import read_size
from roleatlas.sources.store import ListingStore
from roleatlas.streaming.landed import FETCHED, stream_fetches

RUNS = [V.RUN_START, "2024-01-04 18:00:00"]


def rows(df):
    return sorted(map(repr, df.select(schemas.LISTING_COLUMNS).collect()))


def files(path):
    return {os.path.join(r, f) for r, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def store(spark, sf, tmp_path):
    made = ListingStore(spark, str(tmp_path / "store"), 4)
    made.create(V.prior_state(spark, sf))
    return made


def test_two_runs_equal_whole_listings(spark, sf, store):
    log = V.fetch_log(spark, sf)
    state = V.prior_state(spark, sf)
    for k, batch in enumerate((V.scraped_batch(spark, sf), second_batch(spark, sf))):
        run = run_ingest(state, batch, log, RUNS[k])
        counts = ingest_version(store, k, k + 1, batch, log, RUNS[k])
        assert counts == run.stats.first().asDict()
        state = run.listings
        assert rows(store.listings(k + 1)) == rows(state)
    # Earlier versions stay as they were.
    assert rows(store.listings(0)) == rows(V.prior_state(spark, sf)) and store.latest() == 2


def test_stored_rows_are_not_moved(spark, sf, store, tmp_path):
    log, batch = V.fetch_log(spark, sf), V.scraped_batch(spark, sf)
    ingest_version(store, 0, 1, batch, log, RUNS[0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        winners = ST.last_values(ST.storable(batch)).withColumns({
            "url_hash": F.lit(1).cast("long"), "text_digest": F.lit(""), "text_length": F.lit(0),
            "fetched_at": F.lit(RUNS[1]).cast("timestamp"),
        })
        merged = ST.merge_status(store.status(1), winners, 2)
        text = merged._jdf.queryExecution().executedPlan().toString()
        stored = text[text.index("FullOuter"):text.index("status_1")]
        assert "Exchange" not in stored and "texts" not in text and text.count("Exchange hashpartitioning(url") == 1
        whole = store.listings(1)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in whole and "Exchange" not in whole
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_changed_descriptions_are_written(spark, sf, store):
    log, batch = V.fetch_log(spark, sf), V.scraped_batch(spark, sf)
    ingest_version(store, 0, 1, batch, log, RUNS[0])
    before = files(f"{store.root}/texts")
    ingest_version(store, 1, 2, batch, log, RUNS[1])
    assert files(f"{store.root}/texts") == before
    assert store.status(2).filter(F.col("last_refreshed") == F.lit(RUNS[1]).cast("timestamp")).count() > 0
    # Touch and expiry alone rewrite status rows.
    names = store.status(2).select("company").distinct()
    off = ST.expire_unrefreshed(ST.touch_refreshed(store.status(2), batch, RUNS[1]), names, ST.END_OF_TIME)
    store.write_status(off, 3)
    assert files(f"{store.root}/texts") == before and store.listings(3).filter("is_active").count() == 0
    assert rows(store.listings(3).drop("is_active", "last_refreshed").withColumns(
        {"is_active": F.lit(0), "last_refreshed": F.lit(0)})) == rows(
        store.listings(2).withColumns({"is_active": F.lit(0), "last_refreshed": F.lit(0)}))


def test_a_version_written_again_is_the_same(spark, sf, store):
    log, batch = V.fetch_log(spark, sf), V.scraped_batch(spark, sf)
    first = ingest_version(store, 0, 1, batch, log, RUNS[0])
    once = rows(store.listings(1))
    assert ingest_version(store, 0, 1, batch, log, RUNS[0]) == first
    assert rows(store.listings(1)) == once
    # Another session's catalog knows nothing of the store yet.
    other = ListingStore(spark.newSession(), store.root, 4)
    for table in (store.status_table(1), store.text_table()):
        spark.sql(f"DROP TABLE {table}")
    assert rows(other.listings(1)) == once


def fetch(at, company, status=200, urls=(), n_jobs=None, total=None, text="x" * 200):
    moment = dt.datetime.fromisoformat(at)
    n_jobs = len(urls) if n_jobs is None else n_jobs
    base = {c.split()[0]: None for c in FETCHED.split(", ")} | {"company": company, "fetched_at": moment}
    out = [base | {"outcome": True, "http_status": status, "timed_out": False, "n_jobs": n_jobs, "total": total}]
    for k, url in enumerate(urls):
        out.append(base | {"outcome": False, "seq": k, "url": url, "title": "Data Engineer", "description_raw": text})
    return out


def land(spark, folder, fetches):
    names = [c.split()[0] for c in FETCHED.split(", ")]
    data = [tuple(r[n] for n in names) for f in fetches for r in f]
    spark.createDataFrame(data, FETCHED).coalesce(1).write.mode("append").parquet(folder)


def state_of(store):
    listed = store.listings(store.latest())
    return {r["url"]: (r["is_active"], r["last_refreshed"].isoformat(" ")) for r in listed.collect()}


def test_streamed_grace_expiry_and_return(spark, tmp_path):
    """Expired, deactivated, kept for a day and returned rows, fetch by fetch."""
    store = ListingStore(spark, str(tmp_path / "store"), 2)
    store.create(spark.createDataFrame([], schemas.LISTINGS))
    folder, offsets = str(tmp_path / "landed"), str(tmp_path / "offsets")
    one, two, day = "2024-03-01 06:00:00", "2024-03-01 18:00:00", "2024-03-02 06:00:01"

    def run(*fetches):
        land(spark, folder, fetches)
        follow(stream_fetches(spark, folder, store, offsets))
        return state_of(store)

    first = run(fetch(one, "a", urls=["a1", "a2"]), fetch(one, "b", urls=["b1"]), fetch(one, "c", urls=["c1", "c2"], total=9000))
    assert first == {u: (True, one) for u in ("a1", "a2", "b1", "c1", "c2")}
    second = run(
        fetch(two, "a", urls=["a1"]), fetch(two, "b", status=404, n_jobs=0), fetch(two, "c", urls=["c1"], total=9000))
    assert second == {
        "a1": (True, two), "a2": (False, one), "b1": (False, one), "c1": (True, two), "c2": (True, one)}
    third = run(fetch(day, "c", urls=["c1"], total=9000), fetch(day, "a", status=500), fetch(day, "b", urls=["b1"]))
    assert third == {
        "a1": (True, two), "a2": (False, one), "b1": (True, day), "c1": (True, day), "c2": (False, one)}
    # Two fetches of a company in one micro-batch: rows in order of time, the last outcome decides.
    later, last = "2024-03-03 00:00:00", "2024-03-03 12:00:00"
    fourth = run(fetch(last, "a", urls=["a2"]), fetch(later, "a", urls=["a1", "a3"]))
    assert fourth["a1"] == (False, later) and fourth["a2"] == (True, last) and fourth["a3"] == (False, later)
    assert store.latest() == 4


def test_replayed_fetches_give_the_same_version(spark, sf, store, tmp_path):
    folder, offsets = str(tmp_path / "landed"), str(tmp_path / "offsets")
    land_fetches(spark, sf, V.scraped_batch(spark, sf), RUNS[0], folder, 1)
    follow(stream_fetches(spark, f"{folder}/*", store, offsets))
    once = rows(store.listings(1))
    # Forget that the batch was committed, as after a lost driver.
    replay = str(tmp_path / "replayed")
    shutil.copytree(offsets, replay, ignore=lambda d, names: names if d.endswith("commits") else [])
    follow(stream_fetches(spark, f"{folder}/*", store, replay))
    assert store.latest() == 1 and rows(store.listings(1)) == once


def files_by_part(folder):
    return {p.name: len(list(p.glob("*.parquet"))) for p in Path(folder).iterdir() if p.name.startswith("part=")}


def test_landed_parts_do_not_pass_through_one_task(spark, sf, tmp_path, monkeypatch):
    land_fetches(spark, sf, V.scraped_batch(spark, sf), RUNS[0], str(tmp_path / "landed"), 2, 1)
    found = files_by_part(tmp_path / "landed")
    assert set(found) == {"part=1"} and found["part=1"] > 1
    asked = []

    def seen(spark, landed, *args, **more):
        asked.append((files_by_part(landed.rstrip("*")), more["files_per_batch"]))
        return landed_upserts(spark, landed, *args, **more)

    landed_upserts = T.stream_upserts
    monkeypatch.setattr(T, "stream_upserts", seen)
    streamed = sorted(map(repr, T.s1(spark, sf).collect()))
    (parts, at_once), = asked
    assert len(parts) == 4 and min(parts.values()) > 1
    assert 3 * at_once < sum(parts.values()) <= 4 * at_once
    assert streamed == sorted(map(repr, T.j1(spark, sf).collect()))


def test_buckets_follow_the_input(spark, sf, monkeypatch):
    state = V.prior_state(spark, sf)
    few = T.bucket_count(state)
    monkeypatch.setattr(T, "BUCKET_BYTES", max(1, read_size(state) // 20))
    assert few == 8 and 20 <= T.bucket_count(state) <= 21
    assert T.new_store(spark, sf).buckets == T.bucket_count(state)
