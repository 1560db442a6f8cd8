"""Table storage: versioned snapshots, bucketed tables, dump files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import lookup_join, materialize


def write_snapshot(df: DataFrame, root: str, version: str | int) -> str:
    """Write one version of a table to a directory of its own.

    The version being read is never overwritten; writing the same version again
    replaces it, so a repeated job is harmless.
    """
    path = f"{root.rstrip('/')}/version={version}"
    writer = df.write.mode("overwrite")
    if "is_active" in df.columns:
        writer = writer.partitionBy("is_active")
    writer.parquet(path)
    return path


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """A listings version; ``is_active`` filters prune whole directories."""
    return spark.read.schema(schemas.LISTINGS).parquet(path).select(schemas.LISTING_COLUMNS)


def empty_listings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.LISTINGS)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Store a table bucketed and sorted by its key, so joins on it need no exchange."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def unescape_copy(field: Column) -> Column:
    """One field of a COPY text line: ``\\N`` is NULL, backslash codes are undone."""
    # NUL cannot occur in such a file, so it may stand for a literal backslash.
    plain = F.replace(field, F.lit("\\\\"), F.lit("\u0000"))
    for code, char in [
        ("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\b", "\b"), ("\\f", "\f"), ("\\v", "\v"),
    ]:
        plain = F.replace(plain, F.lit(code), F.lit(char))
    return F.when(field != "\\N", F.replace(plain, F.lit("\u0000"), F.lit("\\")))


def read_copy(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Tab-separated COPY text, gzipped or not, as strings.

    One gzip file is one task; a large dump should be split over many files.
    """
    fields = F.split(F.col("value"), "\t")
    rows = spark.read.text(path, lineSep="\n")
    return rows.select(
        *[unescape_copy(F.get(fields, i)).alias(c) for i, c in enumerate(columns)]
    )


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the same one on every run.

    Row numbers decide in a hash aggregate; only the rows of keys that come more than
    once are compared, and what loses, mostly little, is taken out.  Rows without the key
    count as rows of one key.
    """
    rows = materialize(df.withColumns({
        "_row": F.monotonically_increasing_id(), "_order": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
    }))
    chosen = rows.groupBy(F.col(key).alias("_key")).agg(
        F.min_by("_row", "_order").alias("_first"), F.count("*").alias("_n")
    ).filter("_n > 1").select("_key", "_first")
    several = rows.select("_row", F.col(key).alias("_own"))
    losers = several.join(chosen, F.col("_own").eqNullSafe(F.col("_key"))).filter("_row <> _first").select("_row")
    return lookup_join(rows, materialize(losers), ["_row"], "left_anti").select(df.columns)


def load_dump(
    spark: SparkSession, directory: str, listings: DataFrame, vectors: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """A10: add a dump to the tables, skipping rows that break a unique key.

    Listings come first; a dumped vector needs a listing, as the foreign key asks.
    """
    raw = read_copy(spark, f"{directory}/job_listings.copy.gz", schemas.LISTING_COLUMNS)
    staged = raw.withColumns({
        "url_hash": F.col("url_hash").cast("long"),
        "scraped_at": F.col("scraped_at").cast("timestamp"),
        "last_refreshed": F.col("last_refreshed").cast("timestamp"),
        "is_active": F.col("is_active") == "t",
    })
    fresh = staged.join(listings.select("url"), "url", "left_anti").join(
        listings.select("url_hash"), "url_hash", "left_anti"
    )
    fresh = one_per_key(one_per_key(fresh, "url"), "url_hash")
    all_listings = listings.unionByName(fresh.select(schemas.LISTING_COLUMNS))

    raw_vectors = read_copy(
        spark, f"{directory}/position_vectors.copy.gz", ["url_hash", "role_vec"]
    )
    staged_vectors = raw_vectors.select(
        F.col("url_hash").cast("long").alias("url_hash"),
        F.from_json("role_vec", "array<float>").alias("role_vec"),
    )
    fresh_vectors = one_per_key(
        staged_vectors.join(vectors.select("url_hash"), "url_hash", "left_anti")
        .join(all_listings.select("url_hash"), "url_hash", "left_semi"),
        "url_hash",
    )
    return all_listings, vectors.unionByName(fresh_vectors.select("url_hash", "role_vec"))


def write_copy(df: DataFrame, path: str) -> None:
    """Dump a table of scalars and arrays as gzipped COPY text."""

    def escaped(c: str, kind: str) -> Column:
        value = F.col(f"`{c}`")
        if kind == "boolean":
            value = F.when(value, "t").otherwise("f")
        elif kind.startswith("array"):
            value = F.to_json(value)
        else:
            value = value.cast("string")
        for char, code in [
            ("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"),
            ("\b", "\\b"), ("\f", "\\f"), ("\v", "\\v"),
        ]:
            value = F.replace(value, F.lit(char), F.lit(code))
        return F.coalesce(value, F.lit("\\N"))

    line = F.concat_ws("\t", *[escaped(c, kind) for c, kind in df.dtypes])
    df.select(line.alias("value")).write.mode("overwrite").text(path, compression="gzip")
