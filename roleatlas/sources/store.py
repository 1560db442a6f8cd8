"""The listings as a store of versions: narrow status rows apart from descriptions.

A version of the status table has every column but the description, in whose place it
says by digest, length and version which text is meant.  Descriptions are written once,
by the version that brought them.  Both are bucketed by ``url``, so a run joins its batch
to the stored rows where they lie, moves and rewrites status rows only, and never reads a
stored description.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

STATUS_COLUMNS = [c for c in schemas.LISTING_COLUMNS if c != "description_raw"]
TEXT_COLUMNS = ["text_digest", "text_length", "text_version"]
STATUS = (
    ", ".join(f for f in schemas.LISTINGS.split(", ") if not f.startswith("description_raw "))
    + ", text_digest string, text_length int, text_version long"
)
TEXTS = "url string, url_hash long, description_raw string, version long"
BUCKETS = 200


def text_digest(text: Column) -> Column:
    """SHA-256 of a description, empty for an empty one."""
    return F.when(text != "", F.sha2(text, 256)).otherwise("")


class ListingStore:
    """Versions below ``root``; the number of buckets is fixed when it is made.

    Tables are declared in the session's catalog over their folders, so any session can
    open a store.  A version that is written again is replaced, with the same result.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.name = f"listings_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}"

    def declare(self, name: str, schema: str, path: str, partition: str | None = None) -> str:
        parted = f"PARTITIONED BY ({partition})" if partition else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet {parted} "
            f"CLUSTERED BY (url) SORTED BY (url) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        return name

    def status_table(self, version: int) -> str:
        return self.declare(f"{self.name}_status_{version}", STATUS, f"{self.root}/status/version={version}")

    def text_table(self) -> str:
        return self.declare(f"{self.name}_texts", TEXTS, f"{self.root}/texts", "version")

    def status(self, version: int) -> DataFrame:
        """One narrow row per listing."""
        return self.spark.table(self.status_table(version))

    def texts(self, version: int) -> DataFrame:
        """Descriptions, also former ones, of this and all earlier versions."""
        name = self.text_table()
        # Another session may have added versions.
        self.spark.catalog.recoverPartitions(name)
        return self.spark.table(name).filter(F.col("version") <= version)

    def listings(self, version: int) -> DataFrame:
        """The listings of a version with their descriptions; both sides are joined by bucket."""
        texts = self.texts(version).select(
            F.col("url").alias("_url"), F.col("version").alias("_version"), "description_raw"
        )
        # The version is no key of the join, since the buckets are those of the URL alone.
        same = (F.col("url") == F.col("_url")) & (F.col("text_version") - F.col("_version") == 0)
        joined = self.status(version).join(texts, same, "left")
        return joined.withColumn("description_raw", F.coalesce("description_raw", F.lit(""))).select(
            schemas.LISTING_COLUMNS
        )

    def latest(self) -> int:
        """The highest version that has status rows."""
        rows = self.spark.read.schema("url string, version long").parquet(f"{self.root}/status")
        return rows.agg(F.max("version")).first()[0] or 0

    def write_status(self, rows: DataFrame, version: int) -> None:
        """Write or replace the status rows of a version."""
        columns = [*STATUS_COLUMNS, *TEXT_COLUMNS]
        rows.select(columns).write.mode("overwrite").insertInto(self.status_table(version))

    def write_texts(self, rows: DataFrame, version: int) -> None:
        """Write or replace the descriptions that a version brings; those of others stay."""
        name = f"{self.name}_added"
        rows.select("url", "url_hash", "description_raw").createOrReplaceTempView(name)
        rows.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {self.text_table()} PARTITION (version = {int(version)}) SELECT * FROM {name}"
        )
        rows.sparkSession.catalog.dropTempView(name)

    def create(self, listings: DataFrame, version: int = 0) -> int:
        """Store whole listings as a first version."""
        text = F.col("description_raw")
        self.write_texts(listings.filter(text != ""), version)
        own = F.when(text != "", F.lit(version).cast("long"))
        self.write_status(listings.select(
            *STATUS_COLUMNS, text_digest(text).alias("text_digest"), F.length(text).alias("text_length"),
            own.alias("text_version"),
        ), version)
        return version
