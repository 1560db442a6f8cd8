"""Views over the driver's tables, each as a DataFrame and as SQL.

The same arithmetic on the same keys builds both sides, so a query and its oracle
start from equal rows.  The views keep every row of the table they read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.regex import text
from ..functions.urls import clean_ats_url, url_host
from ..session import spread

PREFIXES = ["", "Senior ", "Staff ", "Lead "]
SUFFIXES = ["", " II", " - Remote"]
BASES = [
    "Data Scientist", "Data Engineer", "Software Engineer", "Product Manager", "UX Designer",
    "Event Manager", "AI Engineer", "Project Manager", "Technical Program Manager",
    "Machine Learning Engineer",
]
TITLES = [
    "Senior Data Scientist", "139 data jobs in Berlin", "Careers Home", "VP Product",
    "Software Engineer II", "Designer / Developer", "unknown", "Events Manager",
]
LOCATIONS = ["", "2 Locations", "Hybrid", "Berlin", "San Francisco, CA"]
STATE_START = "2024-01-01 00:00:00"
RUN_START = "2024-01-04 00:00:00"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    read = spark.read.parquet(f"{d}/{name}.parquet")
    # Text is worth spreading: its cleaning costs far more than moving it once.
    return spread(read) if name in ("documents", "pages") else read


def pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def pages(spark: SparkSession, d: str) -> DataFrame:
    """V1: web pages as listings."""
    t = table(spark, d, "pages")
    return t.select(
        "page_id", "url", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.col("html").alias("description_raw"), url_host(F.col("url")).alias("company"),
    )


def role_listings(spark: SparkSession, d: str) -> DataFrame:
    """V2: listings with vectors."""
    t = table(spark, d, "embeddings")
    i = F.col("vec_id")
    return t.select(
        i.alias("url_hash"),
        F.concat(
            F.lit("https://jobs.lever.co/c"), F.col("label").cast("string"), F.lit("/"), i.cast("string")
        ).alias("url"),
        F.concat(F.lit("company"), (i % 7).cast("string")).alias("company"),
        F.concat(pick(PREFIXES, i % 4), pick(BASES, F.col("label")), pick(SUFFIXES, i % 3)).alias("title"),
        (i % 10 != 9).alias("is_active"),
        F.col("embedding").alias("role_vec"),
        F.lit("").alias("seniority"),
    )


def listings_of(v2: DataFrame) -> DataFrame:
    return v2.drop("role_vec")


def vectors_of(v2: DataFrame) -> DataFrame:
    return v2.select("url_hash", "role_vec")


def documents(spark: SparkSession, d: str) -> DataFrame:
    """V3: documents as listings."""
    t = table(spark, d, "documents")
    i = F.col("doc_id")
    return t.select(
        i,
        F.concat(
            F.lit("https://boards.greenhouse.io/"), F.col("source"), F.lit("/jobs/"),
            i.cast("string"), F.lit("?utm_source=x"),
        ).alias("url"),
        F.col("source").alias("company"), F.col("text").alias("description_raw"),
        pick(TITLES, i % 8).alias("title"), pick(LOCATIONS, i % 5).alias("location"),
    )


def prior_state(spark: SparkSession, d: str) -> DataFrame:
    """V4: what earlier runs stored; the key stands in for the digest."""
    i = F.col("doc_id")
    start = F.lit(STATE_START).cast("timestamp")
    return documents(spark, d).filter(i % 3 != 0).select(
        clean_ats_url(F.col("url")).alias("url"), i.alias("url_hash"),
        F.when(i % 13 == 0, "").otherwise(F.col("title")).alias("title"), "company",
        "description_raw", "location", F.lit("").alias("remote_onsite"),
        F.lit("").alias("seniority"), F.lit("").alias("posted_date"),
        F.lit("ats").alias("source_domain"), start.alias("scraped_at"),
        (start + F.make_interval(hours=(i % 72).cast("int"))).alias("last_refreshed"),
        (i % 11 != 0).alias("is_active"),
    )


def scraped_batch(spark: SparkSession, d: str) -> DataFrame:
    """V5: what the boards serve now; every fourth row comes twice."""
    v3 = documents(spark, d)
    i = F.col("doc_id")
    copies = (
        F.when(i % 4 == 0, F.array(F.lit(1), F.lit(2))).when(i % 2 == 0, F.array(F.lit(1)))
        .otherwise(F.array(F.lit(0)))
    )
    rows = v3.select("*", F.explode(copies.cast("array<long>")).alias("seq"))
    return rows.select(
        "doc_id", "company", "seq", "url",
        F.when(F.col("seq") == 2, "").otherwise(F.col("title")).alias("title"),
        "description_raw",
        F.when(F.col("seq") == 2, "Berlin").otherwise(F.col("location")).alias("location"),
        F.lit("").alias("remote_onsite"), F.lit("").alias("posted_date"),
        F.lit("ats").alias("source_domain"),
    )


def fetch_log(spark: SparkSession, d: str) -> DataFrame:
    """V6: one fetch outcome per source."""
    k = F.regexp_extract("source", r"(\d+)", 1).cast("int") % 5
    names = table(spark, d, "documents").select("source").distinct()
    return names.select(
        F.col("source").alias("company"),
        F.when(k == 3, None).when(k == 2, 404).otherwise(200).cast("int").alias("http_status"),
        (k == 3).alias("timed_out"),
        F.when(k.isin(0, 1), 10).otherwise(0).cast("long").alias("n_jobs"),
        F.when(k == 1, 2500).otherwise(10).cast("long").alias("total"),
    )


def vector_pairs(spark: SparkSession, d: str) -> DataFrame:
    """V7: role vectors with a target that shares their label's mean.

    The label means are ten vectors; they go through the float type so that both
    engines store the same numbers.
    """
    from ..functions.vectors import vector_mean

    v2 = role_listings(spark, d)
    labeled = v2.withColumn("label", F.regexp_extract("url", r"/c(\d+)/", 1).cast("int"))
    means = labeled.groupBy("label").agg(vector_mean("role_vec").alias("mean_vec"))
    return labeled.join(F.broadcast(means), "label").select(
        "url_hash", "company", "title", "label", "role_vec",
        F.zip_with(
            "role_vec", "mean_vec", lambda x, m: (x.cast("double") * 0.5 + m * 0.5)
        ).alias("resp_vec"),
    )


# --- the same in SQL ---------------------------------------------------------


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


CLEAN_URL = "CASE WHEN contains({0}, 'greenhouse.io/') THEN regexp_replace({0}, '\\?.*$', '') ELSE {0} END"

_VIEWS = {
    "v1": (
        [],
        r"""SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
            html AS description_raw, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS company
            FROM pages""",
    ),
    "v2": (
        [],
        f"""SELECT vec_id AS url_hash,
            'https://jobs.lever.co/c' || label || '/' || vec_id AS url,
            'company' || (vec_id % 7) AS company,
            ({_list(PREFIXES)})[vec_id % 4 + 1] || ({_list(BASES)})[label + 1]
              || ({_list(SUFFIXES)})[vec_id % 3 + 1] AS title,
            vec_id % 10 <> 9 AS is_active, embedding AS role_vec, label, '' AS seniority
            FROM embeddings""",
    ),
    "v3": (
        [],
        f"""SELECT doc_id,
            'https://boards.greenhouse.io/' || source || '/jobs/' || doc_id || '?utm_source=x' AS url,
            source AS company, text AS description_raw,
            ({_list(TITLES)})[doc_id % 8 + 1] AS title,
            ({_list(LOCATIONS)})[doc_id % 5 + 1] AS location
            FROM documents""",
    ),
    "v4": (
        ["v3"],
        f"""SELECT regexp_replace(url, '\\?.*$', '') AS url, doc_id AS url_hash,
            CASE WHEN doc_id % 13 = 0 THEN '' ELSE title END AS title, company, description_raw,
            location, '' AS remote_onsite, '' AS seniority, '' AS posted_date,
            'ats' AS source_domain, TIMESTAMP '{STATE_START}' AS scraped_at,
            TIMESTAMP '{STATE_START}' + to_hours(doc_id % 72) AS last_refreshed,
            doc_id % 11 <> 0 AS is_active, doc_id
            FROM v3 WHERE doc_id % 3 <> 0""",
    ),
    "v5": (
        ["v3"],
        """SELECT doc_id, company, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS seq, url, title,
            description_raw, location FROM v3
            UNION ALL
            SELECT doc_id, company, 2, url, '', description_raw, 'Berlin' FROM v3
            WHERE doc_id % 4 = 0""",
    ),
    "v6": (
        [],
        r"""SELECT company, CASE k WHEN 3 THEN NULL WHEN 2 THEN 404 ELSE 200 END AS http_status,
            k = 3 AS timed_out, CASE WHEN k IN (0, 1) THEN 10 ELSE 0 END AS n_jobs,
            CASE WHEN k = 1 THEN 2500 ELSE 10 END AS total
            FROM (SELECT DISTINCT source AS company,
                  regexp_extract(source, '(\d+)', 1)::INTEGER % 5 AS k FROM documents)""",
    ),
    "v7": (
        ["v2"],
        """SELECT url_hash, company, title, role_vec, label,
            list_transform(list_zip(role_vec, mean_vec),
              lambda p: p[1]::DOUBLE * 0.5 + p[2] * 0.5) AS resp_vec
            FROM v2 JOIN (
              SELECT label, list(m ORDER BY i) AS mean_vec FROM (
                SELECT label, i, avg(x) AS m FROM (
                  SELECT label, unnest(role_vec)::DOUBLE AS x,
                         generate_subscripts(role_vec, 1) AS i FROM v2)
                GROUP BY label, i) GROUP BY label) USING (label)""",
    ),
}


def with_views(names: list[str], body: str, **more: str) -> str:
    """``body`` under a WITH clause of the named views and further named parts."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        needs, sql = _VIEWS[name]
        for n in needs:
            add(n)
        parts.setdefault(name, sql)

    for name in names:
        add(name)
    parts.update(more)
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n" + body


__all__ = [
    "documents", "fetch_log", "listings_of", "pages", "prior_state", "role_listings",
    "scraped_batch", "table", "text", "vector_pairs", "vectors_of", "with_views",
]
