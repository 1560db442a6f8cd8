"""Upsert, touch, expire, and the whole ingestion pass."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roleatlas import schemas
from roleatlas.catalog import views as V
from roleatlas.functions.listings import sanitize
from roleatlas.functions.urls import url_hash
from roleatlas.operators import state as ST
from roleatlas.operators import vector_table
from roleatlas.plans.ingest import run_ingest
from roleatlas.sources import snapshots
from roleatlas.sources.companies import classify_fetch

NOW = dt.datetime(2024, 1, 4)
OLD = dt.datetime(2024, 1, 1)


@pytest.fixture
def make_state(spark):
    def make(*rows):
        full = []
        for url, more in rows:
            row = {
                "url": url, "url_hash": abs(hash(url)) % 10**9, "title": "T", "company": "acme", "description_raw": "D",
                "location": "", "remote_onsite": "", "seniority": "", "posted_date": "", "source_domain": "ats",
                "scraped_at": OLD, "last_refreshed": OLD, "is_active": True, **more,
            }
            full.append(tuple(row[c] for c in schemas.LISTING_COLUMNS))
        return spark.createDataFrame(full, schemas.LISTINGS)

    return make


@pytest.fixture
def make_batch(spark):
    def make(*rows):
        columns = ["company", "seq", "url", "title", "description_raw", "location", "remote_onsite", "posted_date", "source_domain"]
        base = {"company": "acme", "seq": 0, "title": "", "description_raw": "", "location": "", "remote_onsite": None,
                "posted_date": None, "source_domain": "ats"}
        data = [tuple({**base, **r, "seq": r.get("seq", i)}[c] for c in columns) for i, r in enumerate(rows)]
        return spark.createDataFrame(data, schemas.SCRAPED + ", source_domain string")

    return make


def by_url(df):
    return {r["url"]: r for r in df.collect()}


def test_upsert(make_state, make_batch):
    state = make_state(("a", {"title": "old", "is_active": False, "source_domain": "feed"}), ("b", {}))
    batch = make_batch(
        {"url": "a", "title": "new"}, {"url": "a", "title": "", "description_raw": "x" * 51, "location": "Rome"},
        {"url": "https://x.greenhouse.io/1?q=1", "title": "n1\0"}, {"url": "https://x.greenhouse.io/1?q=2", "title": "n2", "source_domain": "other"},
        {"url": "https://jobs.lever.co/acme", "title": "board"}, {"url": "c", "title": " ", "description_raw": "x" * 50},
        {"url": "", "title": "none"}, {"url": None, "title": "none"},
    )
    out = by_url(ST.upsert_listings(state, batch, NOW))
    assert set(out) == {"a", "b", "https://x.greenhouse.io/1"}
    a, new = out["a"], out["https://x.greenhouse.io/1"]
    assert (a["title"], a["description_raw"], a["location"]) == ("new", "x" * 51, "Rome")
    assert a["is_active"] and a["scraped_at"] == OLD and a["last_refreshed"] == NOW and a["source_domain"] == "feed"
    assert (new["title"], new["source_domain"], new["scraped_at"], new["last_refreshed"]) == ("n2", "ats", NOW, NOW)
    assert out["b"]["last_refreshed"] == OLD
    assert ST.new_listing_count(state, batch).first()["n_new"] == 1
    assert [tuple(r) for r in ST.collapsed_urls(batch.filter("url <> ''")).collect()] == [("https://x.greenhouse.io/1", 2)]


def test_hot_url(spark, make_state, make_batch):
    """A third of a batch on one URL: the last non-empty value of each column wins."""
    rows = [{"url": "hot" if i % 3 == 0 else f"u{i}", "title": f"t{i}" if i % 2 else "", "description_raw": "x" * 60,
             "location": f"l{i}" if i < 100 else ""} for i in range(600)]
    out = by_url(ST.upsert_listings(make_state(("hot", {"title": "old"})), make_batch(*rows).repartition(6), NOW))
    assert len(out) == 401
    assert (out["hot"]["title"], out["hot"]["location"]) == ("t597", "l99")


def test_upsert_hashes_new_urls(spark, make_state, make_batch):
    out = ST.upsert_listings(make_state(), make_batch({"url": "https://example.com/a", "title": "t"}), NOW)
    assert out.first()["url_hash"] == 8235568502841796004
    again = ST.upsert_listings(out, make_batch({"url": "https://example.com/a", "title": "t"}), NOW)
    assert again.collect() == out.collect()


def test_touch_and_expire(spark, make_state):
    state = make_state(
        ("https://x.greenhouse.io/1", {"is_active": False}), ("b", {"company": "beta"}), ("c", {"source_domain": "feed"}), ("d", {}),
        ("e", {"last_refreshed": NOW}),
    )
    urls = spark.createDataFrame([("https://x.greenhouse.io/1?z",), ("zz",), ("",), (None,)], "url string")
    touched = by_url(ST.touch_refreshed(state, urls, NOW))
    assert len(touched) == 5 and touched["https://x.greenhouse.io/1"]["last_refreshed"] == NOW
    assert not touched["https://x.greenhouse.io/1"]["is_active"] and touched["b"]["last_refreshed"] == OLD
    names = spark.createDataFrame([("acme",), ("acme",), ("other",)], "company string")
    expired = {u: r["is_active"] for u, r in by_url(ST.expire_unrefreshed(state, names, NOW)).items()}
    assert expired == {"https://x.greenhouse.io/1": False, "b": True, "c": True, "d": False, "e": True}
    off = {u: r["is_active"] for u, r in by_url(ST.deactivate_company(state, names)).items()}
    assert off == {"https://x.greenhouse.io/1": False, "b": True, "c": True, "d": False, "e": False}


def test_has_description(spark, make_state):
    state = make_state(("a", {"description_raw": "x" * 101}), ("b", {"description_raw": "x" * 100}), ("c", {"description_raw": "x" * 200}))
    asked = spark.createDataFrame([("a",), ("b",), ("z",)], "url string")
    assert [r["url"] for r in ST.has_description(state, asked).collect()] == ["a"]


def test_ingest_equals_its_parts(spark, sf):
    """One fused pass gives what upsert, touch and expire give one after another."""
    state, batch, log = V.prior_state(spark, sf), V.scraped_batch(spark, sf), V.fetch_log(spark, sf)
    now = V.RUN_START
    statuses = classify_fetch(log)
    served = batch.join(statuses.filter("status = 'ok'"), "company", "left_semi")
    step = ST.upsert_listings(state, sanitize(served), now)
    step = ST.touch_refreshed(step, served, now)
    for kind, cutoff in [("normal", now), ("partial", "2024-01-03 00:00:00"), ("stale", ST.END_OF_TIME)]:
        names = ST.expiry_cutoffs(statuses, now).filter(F.col("kind") == kind)
        step = ST.expire_unrefreshed(step, names, cutoff)
    run = run_ingest(state, batch, log, now)
    assert sorted(step.collect(), key=repr) == sorted(run.listings.collect(), key=repr)
    assert step.count() == step.select("url").distinct().count()


def test_ingest_twice_and_written_stats(spark, sf, tmp_path):
    state, batch, log = V.prior_state(spark, sf), V.scraped_batch(spark, sf), V.fetch_log(spark, sf)
    run = run_ingest(state, batch, log, V.RUN_START)
    path, counts = run.write(str(tmp_path), 1)
    assert counts == {k: v for k, v in run.stats.first().asDict().items()}
    first = snapshots.read_listings(spark, path)
    second = run_ingest(first, batch, log, "2024-01-04 06:00:00")
    assert second.stats.first()["listings_new"] == 0
    drop = ["last_refreshed"]
    assert sorted(first.drop(*drop).collect(), key=repr) == sorted(second.listings.drop(*drop).collect(), key=repr)


def test_partial_company_survives_a_day(spark, make_state, make_batch):
    log = spark.createDataFrame([("acme", 200, False, 5, 2500)], schemas.FETCH_LOG)
    state = make_state(("kept", {"last_refreshed": NOW - dt.timedelta(hours=24)}), ("gone", {"last_refreshed": NOW - dt.timedelta(hours=24, seconds=1)}))
    run = run_ingest(state, make_batch({"url": "zz", "title": "Careers Home"}), log, NOW)
    assert {u: r["is_active"] for u, r in by_url(run.listings).items()} == {"kept": True, "gone": False}
    stats = run.stats.first()
    assert (stats["expired_partial"], stats["expired_normal"], stats["listings_scraped"], stats["listings_stored"]) == (1, 0, 1, 0)


def test_untouched_companies(spark, make_state, make_batch):
    log = spark.createDataFrame([
        ("slow", None, True, None, None), ("empty", 200, False, 0, 0), ("lost", None, False, None, None), ("gone", 404, False, 0, None),
    ], schemas.FETCH_LOG)
    state = make_state(*[(c, {"company": c}) for c in ("slow", "empty", "lost", "gone")])
    run = run_ingest(state, make_batch({"url": "q", "company": "slow", "title": "Dev", "description_raw": "x" * 200}), log, NOW)
    assert {u: r["is_active"] for u, r in by_url(run.listings).items()} == {"slow": True, "empty": True, "lost": True, "gone": False}


def test_dump_round_trip(spark, make_state, tmp_path):
    odd = "tab\there\nline\\n back\\slash \\N"
    state = make_state(("a", {"title": odd, "url_hash": 1}), ("b", {"title": "", "url_hash": 2, "is_active": False}))
    vectors = spark.createDataFrame([(1, [0.5, -1.0]), (9, [1.0, 1.0])], schemas.VECTORS)
    snapshots.write_copy(state, str(tmp_path / "job_listings.copy.gz"))
    snapshots.write_copy(vectors, str(tmp_path / "position_vectors.copy.gz"))
    nothing = vectors.limit(0)
    listings, loaded = snapshots.load_dump(spark, str(tmp_path), snapshots.empty_listings(spark), nothing)
    assert sorted(listings.collect()) == sorted(state.collect())
    # A vector without a listing breaks the foreign key and stays out.
    assert [tuple(r) for r in loaded.collect()] == [(1, [0.5, -1.0])]
    # A conflict on either key keeps the stored row.
    clash = make_state(("other", {"url_hash": 1}), ("b", {"url_hash": 7}))
    again, _ = snapshots.load_dump(spark, str(tmp_path), clash, nothing)
    assert sorted(again.collect()) == sorted(clash.collect())


def test_copy_text_as_the_database_writes_it(spark, tmp_path):
    line = "u\t5\tT\\\\n\\tx\t\\N\t\tRome\t\t\t\tats\t2024-01-02 03:04:05.678+00\t2024-01-02 03:04:05+00\tt\n"
    frame = snapshots.read_copy(spark, _gz(tmp_path, line), schemas.LISTING_COLUMNS)
    r = frame.withColumn("scraped_at", F.col("scraped_at").cast("timestamp")).first()
    assert r["title"] == "T\\n\tx" and r["company"] is None and r["description_raw"] == ""
    assert r["scraped_at"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)


def _gz(folder, text):
    import gzip

    path = folder / "file.copy.gz"
    with gzip.open(path, "wt") as f:
        f.write(text)
    return str(path)


def test_hash_matches_everywhere(spark):
    df = spark.createDataFrame([("https://example.com/a",)] * 3, "u string").repartition(3)
    assert {r[0] for r in df.select(url_hash("u")).collect()} == {8235568502841796004}


def test_affected_rows_are_counted(spark, sf):
    from pyspark.sql import Observation

    state, batch = V.prior_state(spark, sf), V.scraped_batch(spark, sf)
    seen = [Observation(n) for n in ("up", "ex", "off", "live")]
    after = ST.upsert_listings(state, batch, V.RUN_START, seen[0]).collect()
    assert seen[0].get["inserted"] == len(after) - state.count() > 0
    companies = state.select("company").distinct()
    active = state.filter("is_active").count()
    left = ST.expire_unrefreshed(state, companies, "2024-01-02", seen[1]).filter("is_active").count()
    assert seen[1].get["expired"] == active - left > 0
    ST.deactivate_company(state, companies, seen[2]).collect()
    assert seen[2].get["expired"] == active
    vectors = state.select("url_hash")
    live = vector_table.live_vectors(vectors, state, seen[3]).count()
    assert live == active and seen[3].get["orphaned"] == state.count() - active


def test_companies_without_a_log_row_are_empty(spark, sf):
    log = V.fetch_log(spark, sf)
    companies = log.select("company").unionByName(spark.createDataFrame([("silent",)], "company string"))
    runs = [
        run_ingest(V.prior_state(spark, sf), V.scraped_batch(spark, sf), log, V.RUN_START, known).stats.first()
        for known in (None, companies)
    ]
    assert [runs[1][c] - runs[0][c] for c in ("companies_total", "empty", "scraped_ok", "expired_normal")] == [1, 1, 0, 0]
