"""Maintenance of the vectors table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.listings import needs_vector
from ..functions.titles import has_title
from ..session import lookup_join, materialize, remove_folder
from .state import counted


# Up to one listing in so many is looked for by its key before its text is read.
FEW = 10


def upsert_vectors(vectors: DataFrame, new: DataFrame) -> DataFrame:
    """Insert or replace by key; the row with the highest ``seq`` wins.

    Only keys that come more than once are compared, so nearly all vectors go
    through no aggregation, which would sort them.
    """
    several = new.groupBy("url_hash").agg(F.count("*").alias("_n")).filter("_n > 1").select("url_hash")
    repeated = lookup_join(new, several, ["url_hash"], "left_semi")
    latest = repeated.groupBy("url_hash").agg(F.max_by("role_vec", "seq").alias("role_vec")).unionByName(
        lookup_join(new, several, ["url_hash"], "left_anti").select("url_hash", "role_vec")
    )
    kept = vectors.join(new.select("url_hash").distinct(), "url_hash", "left_anti")
    return kept.select("url_hash", "role_vec").unionByName(latest)


def unembedded(listings: DataFrame, vectors: DataFrame, limit: int | None = None) -> DataFrame:
    """D2 with C6: active listings with text and without a vector.

    Where little can be pending, the keys alone are held against the vectors, and what is
    left is measured and then fetched with its text; else one anti-join carries the text.
    """
    texts = listings.filter(
        needs_vector(F.col("title"), F.col("description_raw"), F.col("is_active"))
    ).select("url", "url_hash", "title", "description_raw")
    active = listings.filter("is_active").count()
    if limit is None and (active - vectors.count()) * FEW > active:
        return texts.join(vectors.select("url_hash"), "url_hash", "left_anti")
    keys = texts.select("url_hash").join(vectors.select("url_hash"), "url_hash", "left_anti")
    keys = materialize(keys if limit is None else keys.limit(limit))
    return lookup_join(texts, keys.distinct(), ["url_hash"], "left_semi")


def live_vectors(
    vectors: DataFrame, listings: DataFrame, seen: Observation | None = None
) -> DataFrame:
    """D3: drop the vectors whose listing is not active.

    ``seen`` gets the number of ``orphaned`` vectors when the result is used.
    """
    active = listings.filter("is_active").select("url_hash")
    if seen is None:
        return vectors.join(active, "url_hash", "left_semi")
    marked = vectors.join(active.distinct().withColumn("_live", F.lit(True)), "url_hash", "left")
    return counted(marked, seen, orphaned=F.col("_live").isNull()).filter("_live").drop("_live")


def vectors_for(vectors: DataFrame, keys: DataFrame) -> DataFrame:
    """The vectors of a set of keys."""
    return vectors.join(keys.select("url_hash").distinct(), "url_hash", "left_semi")


def embedded_keys(vectors: DataFrame) -> DataFrame:
    """E3."""
    return vectors.select("url_hash").distinct()


def searchable(listings: DataFrame, vectors: DataFrame) -> DataFrame:
    """D1 with C12: active titled listings with their vectors."""
    titled = listings.filter(has_title(F.col("title"), F.col("is_active")))
    return titled.select("url_hash", "title", "company", "seniority", "url").join(
        vectors.select("url_hash", "role_vec"), "url_hash"
    )


def orphan_count(vectors: DataFrame, listings: DataFrame) -> DataFrame:
    """Vectors that break the foreign key to listings."""
    orphans = vectors.join(listings.select("url_hash"), "url_hash", "left_anti")
    return orphans.agg(F.count("*").alias("n_orphans"))


VECTOR_BUCKETS = 256


def write_buckets(vectors: DataFrame, path: str, buckets: int = VECTOR_BUCKETS) -> None:
    """Store vectors in partitions by a hash of their key, each of which can be replaced alone."""
    bucket = F.pmod(F.xxhash64("url_hash"), F.lit(buckets)).cast("int").alias("bucket")
    placed = vectors.select("url_hash", "role_vec", bucket).repartitionByRange("bucket", "url_hash")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{schemas.VECTORS}, bucket int").parquet(path)


def drop_orphans(listings: DataFrame, path: str) -> dict[str, int]:
    """D3 in place: rewrite only the buckets below ``path`` that hold orphans.

    Keys alone are compared.  Returns how many vectors were ``orphaned`` and how many
    buckets ``rewritten``; files of others stay as they are.  Survivors are written apart
    first, so a job that fails halfway can be run again.
    """
    spark = listings.sparkSession
    stored = read_buckets(spark, path)
    active = listings.filter("is_active").select("url_hash")
    orphans = materialize(stored.select("url_hash", "bucket").join(active, "url_hash", "left_anti"))
    counts = {r["bucket"]: r["count"] for r in orphans.groupBy("bucket").count().collect()}
    if not counts:
        return {"orphaned": 0, "rewritten": 0}
    held = stored.filter(F.col("bucket").isin(sorted(counts)))
    kept = materialize(held.join(orphans.select("url_hash").distinct(), "url_hash", "left_anti"))
    left = {r["bucket"] for r in kept.select("bucket").distinct().collect()}
    placed = kept.select("url_hash", "role_vec", "bucket").repartitionByRange("bucket", "url_hash")
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(path)
    # A bucket of orphans alone has nothing to be replaced by.
    for bucket in set(counts) - left:
        remove_folder(spark, f"{path.rstrip('/')}/bucket={bucket}")
    return {"orphaned": sum(counts.values()), "rewritten": len(counts)}
