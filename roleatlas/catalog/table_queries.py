"""Queries for sources and sinks (A), joins (D), counts (E) and state."""

from __future__ import annotations

import os

import numpy as np

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.embedding import HashedTokens, embed
from ..functions.vectors import dot
from ..operators import state as ST
from ..operators import stats, vector_table
from ..operators.deconfound import exact_knn
from ..operators.vector_index import approx_knn, build_index, load_index
from ..plans.encode import encode_in_chunks, encode_new, pending_texts
from ..plans.ingest import ingest_version, run_ingest
from ..schemas import LISTING_COLUMNS
from ..session import materialize, read_size, scratch_path
from ..sources import boards, companies, snapshots
from ..sources.store import ListingStore
from ..streaming.landed import latest_version, scraped_names, stream_fetches, stream_upserts
from . import sql as S
from . import views as V
from .registry import registry
from .text_queries import PENDING, stored_vectors
from .views import with_views

add = registry.add
col = F.col
RUN = V.RUN_START


# --- boards: one payload per document ----------------------------------------


def _payload(array: bool = False, **fields):
    job = F.array(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return F.to_json(job if array else F.struct(job.alias("jobs")))


def _fields(*extra: str):
    return ["slug", "title", "url", "description_raw", "location", "remote_onsite", "posted_date", *extra]


HTML = "'<p>' || text || '</p><ul><li>Pay &amp;amp; perks &#8226; </li></ul><script>x()</script>'"
TEXT = f"CASE WHEN {S.strip('text')} = '' THEN '' ELSE {S.strip('text')} || chr(10) END || 'Pay &amp; perks •'"


def _html(text):
    return F.concat(
        F.lit("<p>"), text, F.lit("</p><ul><li>Pay &amp;amp; perks &#8226; </li></ul><script>x()</script>")
    )


@add(
    "a2_greenhouse_listings",
    with_views(["v3"], f"""SELECT company AS slug, title, v3.url, {TEXT} AS description_raw, location,
        '' AS remote_onsite, CASE WHEN doc_id % 4 = 0 THEN '' ELSE '2024-01-02T03:04:05Z' END AS posted_date
        FROM v3 JOIN documents USING (doc_id)"""),
)
def a2(spark, d):
    t = V.documents(spark, d)
    common = {
        "title": col("title"), "absolute_url": col("url"), "content": _html(col("description_raw")),
        "first_published": F.when(col("doc_id") % 4 != 0, "2024-01-02T03:04:05Z"),
    }
    nested = _payload(**common, location=F.struct(col("location").alias("name")))
    bare = _payload(**common, location=col("location"))
    payloads = t.select(
        col("company").alias("slug"), F.when(col("doc_id") % 2 == 0, nested).otherwise(bare).alias("body")
    )
    return boards.greenhouse_listings(payloads).select(_fields())


@add(
    "a3_lever_listings",
    with_views(["v3"], f"""SELECT company AS slug, title,
        CASE WHEN doc_id % 2 = 0 THEN 'https://jobs.lever.co/' || company || '/' || doc_id ELSE url END AS url,
        CASE WHEN doc_id % 3 < 2 THEN description_raw ELSE title || chr(10) || '- ' || {S.strip('description_raw')} END
        AS description_raw, location, CASE doc_id % 4 WHEN 1 THEN 'remote' WHEN 2 THEN 'hybrid' ELSE '' END AS remote_onsite,
        '1704164645' AS posted_date FROM v3 WHERE NOT {S.is_aggregator('title')}"""),
)
def a3(spark, d):
    i = col("doc_id")
    section = F.struct(
        col("title").alias("text"),
        F.concat(F.lit("<li>"), col("description_raw"), F.lit("</li><li> </li>")).alias("content"),
    )
    body = _payload(
        array=True, id=i.cast("string"), text=F.concat(F.lit(" "), col("title")),
        descriptionPlain=F.when(i % 3 == 0, col("description_raw")),
        description=F.when(i % 3 == 1, col("description_raw")).otherwise(""),
        lists=F.array(section), categories=F.struct("location"),
        workplaceType=V.pick(["on-site", "remote", "hybrid", "unspecified"], i % 4),
        hostedUrl=F.when(i % 2 == 1, col("url")), createdAt=F.lit(1704164645000),
    )
    payloads = V.documents(spark, d).select(col("company").alias("slug"), body.alias("body"))
    return boards.lever_listings(payloads).select(_fields())


@add(
    "a4_ashby_listings",
    with_views(["v3"], f"""SELECT company AS slug, title,
        CASE doc_id % 4 WHEN 0 THEN v3.url WHEN 1 THEN v3.url || '/apply'
          WHEN 2 THEN 'https://jobs.ashbyhq.com/' || company || '/' || doc_id ELSE '' END AS url,
        CASE WHEN doc_id % 3 = 0 THEN text ELSE {TEXT} END AS description_raw,
        CASE WHEN location = '' THEN 'Elsewhere' ELSE location END AS location,
        CASE WHEN doc_id % 5 = 0 THEN 'remote' WHEN doc_id % 5 = 1 THEN 'hybrid' ELSE '' END AS remote_onsite,
        '2024-01-02' AS posted_date FROM v3 JOIN documents USING (doc_id)"""),
)
def a4(spark, d):
    i, url = col("doc_id"), col("url")
    body = _payload(
        id=F.when(i % 4 == 2, i.cast("string")), title=col("title"),
        descriptionPlain=F.when(i % 3 == 0, col("description_raw")).otherwise(""),
        descriptionHtml=_html(col("description_raw")),
        jobUrl=F.when(i % 4 == 0, url), applyUrl=F.when(i % 4 < 2, F.concat(url, F.lit("/apply"))),
        isRemote=F.when(i % 5 == 0, True).otherwise(False),
        workplaceType=F.when(i % 5 < 2, "Hybrid"), locationName=col("location"),
        location=F.lit("Elsewhere"), publishedAt=F.lit("2024-01-02T03:04:05Z"),
    )
    payloads = V.documents(spark, d).select(col("company").alias("slug"), body.alias("body"))
    return boards.ashby_listings(payloads).select(_fields())


@add(
    "a5_workday_listings",
    with_views(["v3"], f"""SELECT company || '/careers' AS slug, title,
        CASE WHEN doc_id % 9 = 0 THEN '' ELSE 'https://' || company || '.wd5.myworkdayjobs.com/careers/job/' || doc_id END AS url,
        CASE WHEN doc_id % 9 = 0 OR doc_id % 2 = 0 OR doc_id % 5 = 0 THEN ''
          ELSE {S.collapse("description_raw || ' More '")} END AS description_raw,
        CASE WHEN doc_id % 10 = 0 THEN '' ELSE location END AS location, '' AS remote_onsite, 'Posted Today' AS posted_date
        FROM v3 WHERE doc_id % 7 <> 0"""),
)
def a5(spark, d):
    i = col("doc_id")
    base = F.concat(F.lit("https://"), col("company"), F.lit(".wd5.myworkdayjobs.com"))
    path = F.concat(F.lit("/job/"), i.cast("string"))
    docs = V.documents(spark, d)

    def page(place):
        job = F.struct(
            col("title"), F.when(i % 9 != 0, path).alias("externalPath"), place.alias("locationsText"),
            F.lit("Posted Today").alias("postedOn"),
        )
        return F.to_json(F.struct(F.lit(1).alias("total"), F.array(job).alias("jobPostings")))

    body = F.when(i % 10 == 0, page(F.array(col("location")))).otherwise(page(col("location")))
    # A slug without a site names no board.
    slug = F.when(i % 7 == 0, col("company")).otherwise(F.concat("company", F.lit("/careers")))
    pages = docs.select(
        slug.alias("slug"), base.alias("base_url"), F.lit(0).cast("long").alias("offset"), body.alias("body")
    )
    url = F.concat(base, F.lit("/careers"), path)
    info = F.struct(F.struct(
        F.concat(F.lit("<p>"), "description_raw", F.lit("</p> More ")).alias("jobDescription")
    ).alias("jobPostingInfo"))
    details = docs.withColumn("info", info).filter(i % 2 == 1).select(
        url.alias("url"), F.to_json("info").alias("body")
    )
    known = docs.filter(i % 5 == 0).select(url.alias("url"))
    return boards.workday_listings(pages, details, known).select(_fields())


@add(
    "a6_route_boards",
    """SELECT s_name AS company, CASE WHEN k = 1 THEN 'greenhouse' WHEN k IN (2, 6) THEN 'lever'
         WHEN k = 3 THEN 'ashby' ELSE 'workday' END AS kind,
       CASE WHEN k = 1 THEN 'g' WHEN k IN (2, 6) THEN 'l' WHEN k = 3 THEN 'a' ELSE 'w' END || s_suppkey AS slug
       FROM (SELECT *, s_suppkey % 7 AS k FROM supplier) WHERE k IN (1, 2, 3, 4, 6)""",
)
def a6(spark, d):
    k, i = col("s_suppkey") % 7, col("s_suppkey").cast("string")

    def slug(letter, ok):
        return F.when(ok, F.concat(F.lit(letter), i)).when(k == 5, "")

    listed = V.table(spark, d, "supplier").select(
        col("s_name").alias("name"), slug("g", k == 1).alias("greenhouse_slug"),
        slug("l", k.isin(1, 2, 6)).alias("lever_slug"), slug("a", k.isin(3, 6)).alias("ashby_slug"),
        slug("w", k.isin(2, 4)).alias("workday_slug"),
    )
    return companies.route_boards(listed)


@add(
    "a1_read_companies",
    """SELECT s_name AS name, 'g' || s_suppkey AS greenhouse_slug, CASE WHEN s_suppkey % 2 = 0 THEN 'l' ELSE '' END AS lever_slug,
       NULL::VARCHAR AS workday_slug, 'i' || s_nationkey AS industry FROM supplier""",
)
def a1(spark, d):
    """Lists of at most a hundred companies per file, each file one JSON array."""
    i = col("s_suppkey")
    row = F.struct(
        col("s_name").alias("name"), F.concat(F.lit("g"), i.cast("string")).alias("greenhouse_slug"),
        F.when(i % 2 == 0, "l").otherwise("").alias("lever_slug"),
        F.concat(F.lit("i"), col("s_nationkey").cast("string")).alias("industry"), F.lit(1).alias("ignored"),
    )
    path = scratch_path(spark, "companies")
    part = F.floor(i / 100).cast("string").alias("part")
    lists = V.table(spark, d, "supplier").groupBy(part).agg(F.to_json(F.collect_list(row)).alias("value"))
    lists.write.partitionBy("part").text(path)
    return companies.read_companies(spark, f"{path}/*").select(
        "name", "greenhouse_slug", "lever_slug", "workday_slug", "industry"
    )


STATUS = """SELECT company, CASE WHEN timed_out THEN 'timeout' WHEN http_status = 404 THEN 'stale_404'
    WHEN http_status IS NULL THEN 'error' WHEN n_jobs > 0 THEN 'ok' ELSE 'empty' END AS status,
    total > 2000 AS partial FROM v6"""


@add("a7_classify_fetch", with_views(["v6"], f"SELECT company, status FROM ({STATUS})"))
def a7(spark, d):
    return companies.classify_fetch(V.fetch_log(spark, d)).select("company", "status")


@add("a8_partial_flag", with_views(["v6"], "SELECT company, total > 2000 AS partial FROM v6"))
def a8(spark, d):
    return V.fetch_log(spark, d).select("company", companies.partial_flag(col("total")).alias("partial"))


STATE_FIELDS = [c for c in LISTING_COLUMNS if c != "url_hash"]


@add("a9_snapshot", with_views(["v4"], f"SELECT {', '.join(LISTING_COLUMNS)} FROM v4"))
def a9(spark, d):
    path = snapshots.write_snapshot(V.prior_state(spark, d), scratch_path(spark, "listings"), 1)
    return snapshots.read_listings(spark, path)


@add(
    "a10_load_dump",
    with_views(["v4"], """SELECT url, url_hash, title, description_raw, location, scraped_at, last_refreshed,
        is_active, round(url_hash * 0.25::DOUBLE, 4) AS x FROM v4"""),
)
def a10(spark, d):
    state = V.prior_state(spark, d)
    vectors = state.select(
        "url_hash", F.array((col("url_hash") * 0.25).cast("float"), F.lit(1.0).cast("float")).alias("role_vec")
    )
    folder = scratch_path(spark, "dump")
    snapshots.write_copy(state, f"{folder}/job_listings.copy.gz")
    snapshots.write_copy(vectors, f"{folder}/position_vectors.copy.gz")
    # Half of the dump is already there, so every row must come out once.
    half = col("url_hash") % 2 == 0
    listings, loaded = snapshots.load_dump(spark, folder, state.filter(half), vectors.filter(half))
    return listings.join(loaded, "url_hash").select(
        "url", "url_hash", "title", "description_raw", "location", "scraped_at", "last_refreshed",
        "is_active", F.round(F.get("role_vec", 0).cast("double"), 4).alias("x"),
    )


def old_and_new_vectors(spark, d):
    v = V.vectors_of(V.role_listings(spark, d))
    i = col("url_hash")
    old = v.filter(i % 3 != 0)
    flipped = v.filter(i % 2 == 0).select(
        i, F.transform("role_vec", lambda x: -x).alias("role_vec"), F.lit(1).alias("seq")
    )
    zero = v.filter(i % 4 == 0).select(
        i, F.transform("role_vec", lambda x: x * 0).alias("role_vec"), F.lit(2).alias("seq")
    )
    return old, flipped.unionByName(zero)


@add(
    "a12_upsert_vectors",
    """SELECT vec_id AS url_hash, round(embedding[1]::DOUBLE * CASE WHEN vec_id % 4 = 0 THEN 0
       WHEN vec_id % 2 = 0 THEN -1 ELSE 1 END, 6) AS x FROM embeddings WHERE vec_id % 3 <> 0 OR vec_id % 2 = 0""",
)
def a12(spark, d):
    merged = vector_table.upsert_vectors(*old_and_new_vectors(spark, d))
    return merged.select("url_hash", F.round(F.get("role_vec", 0).cast("double") + 0.0, 6).alias("x"))


# --- joins -------------------------------------------------------------------


@add(
    "c13_has_description",
    with_views(["v4", "v5"], f"""SELECT v4.url FROM v4 WHERE length(description_raw) > 100
        AND url IN (SELECT {S.clean_url('url')} FROM v5 WHERE seq = 2)"""),
)
def c13(spark, d):
    asked = V.scraped_batch(spark, d).filter("seq = 2")
    urls = asked.select(ST.clean_ats_url(col("url")).alias("url"))
    return ST.has_description(V.prior_state(spark, d), urls)


@add(
    "d1_listings_vectors",
    with_views(["v2"], """SELECT url_hash, title, company, seniority, url, round(role_vec[1]::DOUBLE, 6) AS x
        FROM v2 WHERE is_active AND title <> ''"""),
)
def d1(spark, d):
    v2 = V.role_listings(spark, d)
    both = vector_table.searchable(V.listings_of(v2), V.vectors_of(v2))
    return both.select(
        "url_hash", "title", "company", "seniority", "url",
        F.round(F.get("role_vec", 0).cast("double"), 6).alias("x"),
    )


@add("d2_unembedded", with_views(["v4"], f"SELECT count(*) AS n, sum(url_hash)::BIGINT AS key_sum FROM ({PENDING})"))
def d2(spark, d):
    found = vector_table.unembedded(V.prior_state(spark, d), stored_vectors(spark, d))
    return found.agg(F.count("*").alias("n"), F.sum("url_hash").alias("key_sum"))


@add(
    "d3_live_vectors",
    with_views(["v4"], "SELECT url_hash FROM v4 WHERE doc_id % 5 <> 1 AND is_active"),
)
def d3(spark, d):
    return vector_table.live_vectors(stored_vectors(spark, d), V.prior_state(spark, d)).select("url_hash")


@add(
    "d4_vectors_for",
    """SELECT vec_id AS url_hash, round(embedding[2]::DOUBLE, 6) AS x FROM embeddings
       WHERE vec_id IN (SELECT doc_id FROM documents)""",
)
def d4(spark, d):
    keys = V.table(spark, d, "documents").select(col("doc_id").alias("url_hash"))
    found = vector_table.vectors_for(V.vectors_of(V.role_listings(spark, d)), keys)
    return found.select("url_hash", F.round(F.get("role_vec", 1).cast("double"), 6).alias("x"))


@add(
    "d5_new_listing_count",
    with_views(["v4", "v5"], f"""SELECT count(DISTINCT u) AS n_new FROM (SELECT {S.clean_url('url')} AS u FROM v5
        WHERE trim(title) <> '' OR length(description_raw) > 50) WHERE u NOT IN (SELECT url FROM v4)"""),
)
def d5(spark, d):
    return ST.new_listing_count(V.prior_state(spark, d), V.scraped_batch(spark, d))


@add(
    "q7_collapsed_urls",
    with_views(["v5"], """SELECT regexp_replace(url, '\\?.*$', '') AS url, count(DISTINCT url || seq) AS n_urls
        FROM v5 GROUP BY 1 HAVING count(DISTINCT url || seq) > 1"""),
)
def q7(spark, d):
    rows = V.scraped_batch(spark, d)
    return ST.collapsed_urls(rows.withColumn("url", F.concat("url", col("seq").cast("string"))))


@add(
    "d9_board_details",
    with_views(["v3"], """SELECT company, count(*) AS n_postings,
        count(*) FILTER (WHERE doc_id % 9 <> 0 AND doc_id % 2 = 1 AND doc_id % 5 <> 0) AS n_described
        FROM v3 WHERE doc_id % 7 <> 0 GROUP BY company"""),
)
def d9(spark, d):
    rows = a5(spark, d)
    return rows.groupBy(F.split_part("slug", F.lit("/"), F.lit(1)).alias("company")).agg(
        F.count("*").alias("n_postings"), F.count_if(col("description_raw") != "").alias("n_described")
    )


@add(
    "h4_foreign_key",
    "SELECT count(*) AS n_orphans FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0)",
)
def h4(spark, d):
    vectors = V.vectors_of(V.role_listings(spark, d))
    return vector_table.orphan_count(vectors, V.prior_state(spark, d))


# --- counts ------------------------------------------------------------------


@add("e1_count_active", with_views(["v4"], "SELECT count(*) AS n_active FROM v4 WHERE is_active"))
def e1(spark, d):
    return stats.count_active(V.prior_state(spark, d))


@add("e2_count_embeddings", "SELECT count(*) AS n_vectors FROM embeddings")
def e2(spark, d):
    return stats.count_embeddings(V.vectors_of(V.role_listings(spark, d)))


@add("e3_embedded_keys", "SELECT DISTINCT vec_id AS url_hash FROM embeddings")
def e3(spark, d):
    return vector_table.embedded_keys(V.vectors_of(V.role_listings(spark, d)))


@add(
    "e9_title_collapse",
    with_views(["v1", "v2", "v3"], """SELECT count(*) AS n_titles, count(DISTINCT grp) AS n_groups,
        count(*) FILTER (WHERE grp IS NULL) AS n_ungrouped FROM norm""",
        titles="SELECT title FROM v1 UNION ALL SELECT title FROM v2 UNION ALL SELECT title FROM v3",
        **S.norm_parts("titles")),
)
def e9(spark, d):
    parts = [V.pages(spark, d), V.role_listings(spark, d), V.documents(spark, d)]
    titles = [p.select("title") for p in parts]
    return stats.title_collapse_report(titles[0].unionByName(titles[1]).unionByName(titles[2]))


@add("e9_title_collapse_approximate")
def e9_approximate(spark, d):
    return stats.title_collapse_report(V.documents(spark, d), approximate=True)


@add("e9_merged_sketches", "SELECT TRUE AS titles_close, TRUE AS groups_close, 3::BIGINT AS n_versions")
def e9_sketches(spark, d):
    """Stored sketches of three parts of the listings, merged, against the exact report of all."""
    parts = [V.pages(spark, d), V.role_listings(spark, d), V.documents(spark, d)]
    path = scratch_path(spark, "sketches")
    for k, part in enumerate(parts):
        stats.title_sketches(part, k).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    titles = [p.select("title") for p in parts]
    exact = stats.title_collapse_report(titles[0].unionByName(titles[1]).unionByName(titles[2])).alias("e")
    versions = stored.agg(F.count("*").alias("n_versions"))

    def close(c):
        # Four standard errors.
        return F.abs(col(f"s.{c}") - col(f"e.{c}")) <= F.greatest(F.lit(1.0), 0.032 * col(f"e.{c}"))

    both = stats.collapse_of_sketches(stored).alias("s").join(exact).join(versions)
    return both.select(close("n_titles").alias("titles_close"), close("n_groups").alias("groups_close"), "n_versions")


@add(
    "d3_orphans_in_place",
    with_views(["v4"], """SELECT url_hash, (SELECT count(*) FROM v4 WHERE doc_id % 5 <> 1 AND NOT is_active) AS orphaned
        FROM v4 WHERE doc_id % 5 <> 1 AND is_active"""),
)
def d3_in_place(spark, d):
    """Orphans leave stored vectors bucket by bucket."""
    path = scratch_path(spark, "vectors")
    vector_table.write_buckets(stored_vectors(spark, d), path, 64)
    counts = vector_table.drop_orphans(V.prior_state(spark, d), path)
    left = vector_table.read_buckets(spark, path)
    return left.select("url_hash", F.lit(counts["orphaned"]).cast("long").alias("orphaned"))


# --- state -------------------------------------------------------------------

STORABLE = f"""SELECT doc_id, {S.clean_url('url')} AS url, seq, title, company, description_raw, location
    FROM v5 WHERE url <> '' AND (trim(title) <> '' OR length(description_raw) > 50)"""


def _last(c: str, valid: str = "true") -> str:
    return f"coalesce(arg_max({c}, seq) FILTER (WHERE {valid} AND {c} <> ''), '') AS {c}"


WINNERS = "SELECT url, " + ", ".join(
    _last(c) for c in ["title", "company", "description_raw", "location"]
) + " FROM storable GROUP BY url"


def _merged(valid: str, state: str = "v4", winners: str = "winners", run: str = RUN) -> str:
    def value(c: str) -> str:
        return f"CASE WHEN {valid} AND w.{c} <> '' THEN w.{c} ELSE coalesce(s.{c}, '') END AS {c}"

    columns = ", ".join(value(c) for c in ["title", "company", "description_raw", "location"])
    return f"""SELECT coalesce(s.url, w.url) AS url, {columns}, '' AS remote_onsite, '' AS seniority,
        '' AS posted_date, 'ats' AS source_domain, coalesce(s.scraped_at, TIMESTAMP '{run}') AS scraped_at,
        CASE WHEN w.url IS NOT NULL THEN TIMESTAMP '{run}' ELSE s.last_refreshed END AS last_refreshed,
        ({valid}) OR coalesce(s.is_active, false) AS is_active, s.url IS NOT NULL AS stored, ({valid}) AS valid
        FROM {state} s FULL OUTER JOIN {winners} w ON s.url = w.url"""


J1 = with_views(
    ["v4", "v5"], f"SELECT {', '.join(STATE_FIELDS)} FROM merged", storable=STORABLE, winners=WINNERS,
    merged=_merged("w.url IS NOT NULL"),
)


@add("j1_upsert_listings", J1)
def j1(spark, d):
    # The key of a new row is a digest that SQL does not have; b5 covers it.
    merged = ST.upsert_listings(V.prior_state(spark, d), V.scraped_batch(spark, d), RUN)
    return merged.select(STATE_FIELDS)


@add("f4_last_values", with_views(["v5"], WINNERS, storable=STORABLE))
def f4(spark, d):
    found = ST.last_values(ST.storable(V.scraped_batch(spark, d)))
    return found.select("url", "title", "company", "description_raw", "location")


@add(
    "j2_touch_refreshed",
    with_views(["v4", "v5"], f"""SELECT url, is_active, scraped_at, CASE WHEN url IN
        (SELECT {S.clean_url('url')} FROM v5 WHERE seq = 2) THEN TIMESTAMP '{RUN}' ELSE last_refreshed END AS last_refreshed FROM v4"""),
)
def j2(spark, d):
    served = V.scraped_batch(spark, d).filter("seq = 2")
    touched = ST.touch_refreshed(V.prior_state(spark, d), served, RUN)
    return touched.select("url", "is_active", "scraped_at", "last_refreshed")


EXPIRE_AT = "2024-01-03 00:00:00"


@add(
    "j3_expire_unrefreshed",
    with_views(["v4", "v6"], f"""SELECT url, company, last_refreshed, is_active AND NOT (last_refreshed < TIMESTAMP '{EXPIRE_AT}'
        AND company IN (SELECT company FROM v6 WHERE n_jobs > 0)) AS is_active FROM v4"""),
)
def j3(spark, d):
    named = V.fetch_log(spark, d).filter("n_jobs > 0")
    state = ST.expire_unrefreshed(V.prior_state(spark, d), named, EXPIRE_AT)
    return state.select("url", "company", "last_refreshed", "is_active")


@add(
    "j4_deactivate_company",
    with_views(["v4", "v6"], """SELECT url, company, is_active AND company NOT IN
        (SELECT company FROM v6 WHERE http_status = 404) AS is_active FROM v4"""),
)
def j4(spark, d):
    gone = V.fetch_log(spark, d).filter("http_status = 404")
    state = ST.deactivate_company(V.prior_state(spark, d), gone)
    return state.select("url", "company", "is_active")


@add("h2_normal_companies", with_views(["v6"], f"SELECT company FROM ({STATUS}) WHERE status = 'ok' AND NOT partial"))
def h2(spark, d):
    statuses = companies.classify_fetch(V.fetch_log(spark, d))
    return ST.expiry_cutoffs(statuses, RUN).filter("kind = 'normal'").select("company")


def ingest_parts(state: str = "v4", batch: str = "v5", run: str = RUN, tag: str = "") -> dict[str, str]:
    """The steps of a pass as named parts; ``final`` with its ``tag`` is the next version."""
    return {
        "status": STATUS,
        f"served{tag}": f"""SELECT {batch}.*, url <> '' AND NOT {S.is_garbage_url('url')} AND NOT {S.is_aggregator('title')}
            AND NOT {S.is_garbage_description('description_raw')} AS sane
            FROM {batch} WHERE company IN (SELECT company FROM status WHERE status = 'ok')""",
        f"cleaned{tag}": f"""SELECT {S.clean_url('url')} AS url, seq, title, company, sane,
            {S.clean_description('description_raw')} AS description_raw, {S.clean_location('location')} AS location FROM served{tag}""",
        f"checked{tag}": f"""SELECT *, sane AND (trim(title) <> '' OR length(description_raw) > 50) AS ok FROM cleaned{tag}""",
        f"winners{tag}": "SELECT url, bool_or(ok) AS ok, count(*) AS n_served, count_if(sane) AS n_sane, " + ", ".join(
            _last(c, "ok") for c in ["title", "company", "description_raw", "location"]
        ) + f" FROM checked{tag} GROUP BY url",
        f"merged{tag}": _merged("coalesce(w.ok, false)", state, f"winners{tag}", run),
        f"cutoffs{tag}": f"""SELECT company, CASE WHEN status = 'stale_404' THEN 'stale' WHEN partial THEN 'partial' ELSE 'normal' END AS kind,
            CASE WHEN status = 'stale_404' THEN TIMESTAMP '9999-12-31' WHEN partial THEN TIMESTAMP '{run}' - INTERVAL 24 HOUR
            ELSE TIMESTAMP '{run}' END AS cutoff FROM status WHERE status IN ('ok', 'stale_404')""",
        f"final{tag}": f"""SELECT m.* EXCLUDE (is_active), is_active AND NOT coalesce(last_refreshed < cutoff, false) AS is_active,
            CASE WHEN is_active AND last_refreshed < cutoff THEN kind END AS expired
            FROM merged{tag} m LEFT JOIN cutoffs{tag} USING (company) WHERE stored OR valid""",
    }


INGEST_PARTS = ingest_parts()


def ingest_run(spark, d):
    return run_ingest(
        V.prior_state(spark, d), V.scraped_batch(spark, d), V.fetch_log(spark, d), RUN
    )


@add(
    "j5_run_ingest",
    with_views(["v4", "v5", "v6"], f"SELECT {', '.join(STATE_FIELDS)} FROM final", **INGEST_PARTS),
)
def j5(spark, d):
    return ingest_run(spark, d).listings.select(STATE_FIELDS)


@add(
    "e7_ingest_stats",
    with_views(["v4", "v5", "v6"], """SELECT (SELECT count(*) FROM status) AS companies_total,
        (SELECT count_if(status = 'ok') FROM status)::BIGINT AS scraped_ok,
        (SELECT count_if(status = 'ok' AND partial) FROM status)::BIGINT AS partial,
        (SELECT count_if(status = 'stale_404') FROM status)::BIGINT AS stale_404,
        (SELECT count_if(status = 'timeout') FROM status)::BIGINT AS timed_out,
        (SELECT count_if(status = 'empty') FROM status)::BIGINT AS empty,
        (SELECT count(*) FROM served) AS listings_scraped,
        (SELECT count_if(sane) FROM served)::BIGINT AS listings_stored,
        (SELECT count(*) FROM merged WHERE valid AND NOT stored) AS listings_new,
        (SELECT count_if(expired = 'normal') FROM final)::BIGINT AS expired_normal,
        (SELECT count_if(expired = 'partial') FROM final)::BIGINT AS expired_partial,
        (SELECT count_if(status = 'error') FROM status)::BIGINT AS errors""", **INGEST_PARTS),
)
def e7(spark, d):
    return ingest_run(spark, d).stats


@add("s1_streamed_upserts", J1)
def s1(spark, d):
    """The batch of j1 landed in four parts and upserted a quarter of the files at a time."""
    landed = scratch_path(spark, "landed")
    rows = V.scraped_batch(spark, d).withColumn("part", (col("doc_id") % 8 / 2).cast("int"))
    # Each task writes its own files: no part passes through one task, and the rows of a
    # document stay in one file, so files may be taken in any order.
    rows.drop("doc_id").write.partitionBy("part").parquet(landed)
    files = len(spark.read.schema(rows.drop("doc_id").schema).parquet(landed).inputFiles())
    root = scratch_path(spark, "versions")
    query = stream_upserts(
        spark, os.path.join(landed, "*"), root, scratch_path(spark, "offsets"),
        V.prior_state(spark, d), RUN,
        files_per_batch=max(1, -(-files // 4)), schema=rows.drop("doc_id", "part").schema,
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return snapshots.read_listings(spark, latest_version(spark, root)).select(STATE_FIELDS)


# --- the store: status rows apart from descriptions ----------------------------

RUN2 = "2024-01-04 18:00:00"
# The second run serves two thirds of the rows again, a third of these with another description.
V5B = """SELECT doc_id, company, seq, url, title, CASE WHEN doc_id % 9 = 1 THEN 'Now: ' || description_raw
    ELSE description_raw END AS description_raw, location FROM v5 WHERE doc_id % 3 <> 0"""
TWO_RUNS = INGEST_PARTS | {"v5b": V5B} | ingest_parts("final", "v5b", RUN2, "2")


def second_batch(spark, d):
    text = F.when(col("doc_id") % 9 == 1, F.concat(F.lit("Now: "), "description_raw")).otherwise(col("description_raw"))
    return V.scraped_batch(spark, d).filter("doc_id % 3 <> 0").withColumn("description_raw", text)


# By the optimizer's estimate, which is some times the size of the input's files.
BUCKET_BYTES = 256 * 1024 * 1024


def bucket_count(state) -> int:
    """Buckets that follow the input's size, so that no task reads more at larger ones."""
    return min(4096, max(8, -(-read_size(state) // BUCKET_BYTES)))


def new_store(spark, d) -> ListingStore:
    state = V.prior_state(spark, d)
    store = ListingStore(spark, scratch_path(spark, "store"), bucket_count(state))
    store.create(state)
    return store


@add(
    "j5_stored_runs",
    with_views(["v4", "v5", "v6"], f"SELECT {', '.join(STATE_FIELDS)} FROM final2", **TWO_RUNS),
)
def j5_stored(spark, d):
    """Two passes in a row on a store, eighteen hours apart."""
    store, log = new_store(spark, d), V.fetch_log(spark, d)
    ingest_version(store, 0, 1, V.scraped_batch(spark, d), log, RUN)
    ingest_version(store, 1, 2, second_batch(spark, d), log, RUN2)
    return store.listings(2).select(STATE_FIELDS)


@add(
    "e7_stored_stats",
    with_views(["v4", "v5", "v6"], """SELECT (SELECT count(*) FROM served2) AS listings_scraped,
        (SELECT count(*) FROM merged2 WHERE valid AND NOT stored) AS listings_new,
        (SELECT count_if(expired = 'normal') FROM final2)::BIGINT AS expired_normal,
        (SELECT count_if(expired = 'partial') FROM final2)::BIGINT AS expired_partial,
        (SELECT count(*) FROM final2 f LEFT JOIN final p ON f.url = p.url
         WHERE f.valid AND f.description_raw <> coalesce(p.description_raw, ''))::BIGINT AS texts_added""",
               **TWO_RUNS),
)
def e7_stored(spark, d):
    """What the second pass counts and how many descriptions it adds."""
    store, log = new_store(spark, d), V.fetch_log(spark, d)
    ingest_version(store, 0, 1, V.scraped_batch(spark, d), log, RUN)
    counts = ingest_version(store, 1, 2, second_batch(spark, d), log, RUN2)
    names = ["listings_scraped", "listings_new", "expired_normal", "expired_partial"]
    added = store.texts(2).filter("version = 2").agg(F.count("*").alias("texts_added"))
    return added.select(*[F.lit(counts[c]).cast("long").alias(c) for c in names], "texts_added")


@add("a9_stored_listings", with_views(["v4"], f"SELECT {', '.join(LISTING_COLUMNS)} FROM v4"))
def a9_stored(spark, d):
    """Listings put together again from status rows and descriptions."""
    return new_store(spark, d).listings(0)


def land_fetches(spark, d, rows, at: str, landed: str, parts: int, part: int | None = None) -> None:
    """Each company's rows and the outcome of its fetch in one of ``parts`` folders, or in ``part`` of them.

    Each task writes its own files, so a company may have several; all of them have to be
    in one micro-batch.
    """
    outcomes = V.fetch_log(spark, d).withColumn("outcome", F.lit(True))
    served = rows.select(*scraped_names()).withColumn("outcome", F.lit(False))
    both = served.unionByName(outcomes, allowMissingColumns=True).withColumn("fetched_at", F.lit(at).cast("timestamp"))
    both = both.withColumn("part", F.pmod(F.xxhash64("company"), F.lit(parts)).cast("int"))
    if part is not None:
        both = both.filter(col("part") == part)
    both.write.mode("append").partitionBy("part").parquet(landed)


def follow(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


ALL_FILES = 2**31 - 1


@add(
    "s1_streamed_fetches",
    with_views(["v4", "v5", "v6"], f"SELECT {', '.join(STATE_FIELDS)} FROM final2", **TWO_RUNS),
)
def s1_fetches(spark, d):
    """Both runs of j5_stored_runs as fetches that land half the companies at a time."""
    store, landed, offsets = new_store(spark, d), scratch_path(spark, "fetches"), scratch_path(spark, "offsets")
    for rows, at in ((V.scraped_batch(spark, d), RUN), (second_batch(spark, d), RUN2)):
        for part in range(2):
            land_fetches(spark, d, rows, at, landed, 2, part)
            # All that has landed is one micro-batch, whatever its number of files.
            follow(stream_fetches(spark, os.path.join(landed, "*"), store, offsets, files_per_batch=ALL_FILES))
    return store.listings(store.latest()).select(STATE_FIELDS)


# --- vectors from text -------------------------------------------------------


class LetterCounts:
    """How often some letters occur: an embedder that SQL can repeat."""

    letters = "etaoinsr"

    def __call__(self, texts: list[str]) -> np.ndarray:
        return np.array([[t.count(x) for x in self.letters] for t in texts], float).reshape(len(texts), -1)


_LETTER_INPUT = f"""SELECT doc_id, CASE WHEN length({S.strip('text')}) > {fv.MIN_EMBED_INPUT} THEN text
    ELSE '{fv.EMBED_PLACEHOLDER}' END AS t FROM documents"""
_LETTER_LIST = "[" + ", ".join(f"length(t) - length(replace(t, '{x}', ''))" for x in LetterCounts.letters) + "]"


@add(
    "i3_embed",
    f"""SELECT url_hash, {", ".join(
        f"round(coalesce(v[{k + 1}] / nullif(sqrt(list_sum(list_transform(v, lambda e: e * e))), 0), 0)::FLOAT::DOUBLE, 5) AS {x}"
        for k, x in enumerate(LetterCounts.letters))}
        FROM (SELECT doc_id AS url_hash, list_transform({_LETTER_LIST}, lambda e: e::DOUBLE) AS v FROM ({_LETTER_INPUT}))""",
)
def i3(spark, d):
    """Whole texts as unit vectors of letter counts."""
    texts = V.table(spark, d, "documents").select(col("doc_id").alias("url_hash"), "text")
    vectors = embed(texts, LetterCounts())
    parts = [F.round(F.get("role_vec", k).cast("double"), 5).alias(x) for k, x in enumerate(LetterCounts.letters)]
    return vectors.select("url_hash", *parts)


@add(
    "j6_encode_new",
    with_views(["v4"], f"""SELECT url_hash, n FROM (SELECT url_hash, 64::BIGINT AS n, doc_id FROM v4 WHERE is_active
        AND NOT (doc_id % 5 <> 1) AND length(trim(title || CASE WHEN {S.strip('description_raw')} = '' THEN '' ELSE '. ' || description_raw END)) > 10)
        UNION ALL SELECT url_hash, 1::BIGINT FROM v4 WHERE is_active AND doc_id % 5 <> 1"""),
)
def j6(spark, d):
    encoded = encode_new(V.prior_state(spark, d), stored_vectors(spark, d), HashedTokens(64))
    return encoded.select("url_hash", F.size("role_vec").cast("long").alias("n"))


@add("j6_encode_again", "SELECT 0::BIGINT AS n_pending")
def j6_again(spark, d):
    """A second run finds nothing pending."""
    state = V.prior_state(spark, d)
    first = materialize(encode_new(state, stored_vectors(spark, d), HashedTokens(64)))
    return pending_texts(state, first).agg(F.count("*").alias("n_pending"))


@add("i11_approx_knn")
def i11(spark, d):
    v = V.vectors_of(V.role_listings(spark, d))
    query = v.orderBy("url_hash").first()["role_vec"]
    return approx_knn(v, query, 10).select("url_hash", F.round("sim", 4).alias("sim"))



@add(
    "i11_index_recall",
    """SELECT count(*) AS n_queries, 10 * count(*) AS n_found, TRUE AS recall_reached, TRUE AS all_rows_kept
       FROM embeddings WHERE vec_id % 100 = 0""",
)
def i11_recall(spark, d):
    """Every hundredth vector searched for in a stored index, against an exact search."""
    v = V.vectors_of(V.role_listings(spark, d))
    path = scratch_path(spark, "index")
    build_index(v, path)
    index = load_index(spark, path)
    asked = v.filter("url_hash % 100 = 0").orderBy("url_hash").toArrow()
    keys = asked["url_hash"].to_numpy()
    found = index.search(spark, keys, np.array(asked["role_vec"].to_pylist()), 10)
    exact = exact_knn(v, "role_vec", 10).filter("query % 100 = 0")
    true = exact.select("query", col("neighbor").alias("url_hash"), F.lit(1).alias("hit"))
    counts = found.join(true, ["query", "url_hash"], "left").agg(
        F.countDistinct("query").alias("n_queries"), F.count("*").alias("n_found"), F.count("hit").alias("hits")
    )
    rows = index.rows(spark).count() == v.count()
    return counts.select(
        "n_queries", "n_found", (col("hits") >= 0.9 * col("n_found")).alias("recall_reached"),
        F.lit(rows).alias("all_rows_kept"),
    )


@add(
    "j6_encode_chunks",
    with_views(["v4"], f"""SELECT url_hash, n FROM (SELECT url_hash, 64::BIGINT AS n, doc_id FROM v4 WHERE is_active
        AND NOT (doc_id % 5 <> 1) AND length(trim(title || CASE WHEN {S.strip('description_raw')} = '' THEN '' ELSE '. ' || description_raw END)) > 10)
        UNION ALL SELECT url_hash, 1::BIGINT FROM v4 WHERE doc_id % 5 <> 1"""),
)
def j6_chunks(spark, d):
    """The vectors of j6 in four chunks, orphans still in."""
    state, stored = V.prior_state(spark, d), stored_vectors(spark, d)
    rows = max(1, -(-pending_texts(state, stored).count() // 4))
    encoded = encode_in_chunks(state, stored, scratch_path(spark, "chunks"), HashedTokens(64), chunk_rows=rows)
    return encoded.select("url_hash", F.size("role_vec").cast("long").alias("n"))
