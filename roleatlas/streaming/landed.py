"""Continuous ingestion of landed files.

The pipeline's cadence is a repeated batch; this is its streaming form.  Every
micro-batch writes a version of its own and starts from the one before, so a
batch that is replayed after a failure produces the same version again.

``stream_fetches`` is the whole pass: a fetch of a board lands with the rows it served and a
row that says how it went, in one file or in several of one micro-batch, and upsert, touch, grace and expiry follow from
these, company by company, at the time of the fetch.  ``stream_upserts`` takes rows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.state import upsert_listings
from ..plans.ingest import apply_fetches
from ..sources.companies import classify_fetch
from ..sources.snapshots import read_listings, write_snapshot
from ..sources.store import ListingStore

# A row of a landed fetch: a served listing, or the outcome, which has no URL.
FETCHED = (
    schemas.SCRAPED + ", outcome boolean, http_status int, timed_out boolean, n_jobs long, total long, "
    "fetched_at timestamp"
)


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def stream_upserts(
    spark: SparkSession, landed: str, root: str, checkpoint: str, initial: DataFrame, now,
    files_per_batch: int = 1000, schema: str = schemas.SCRAPED + ", source_domain string",
) -> StreamingQuery:
    """Start a query that upserts new files below ``landed``, then stops.

    Each micro-batch writes the table once, so it takes many files at a time.

    ``now`` is a timestamp or a callable of the batch id that gives one; it has to
    be the same on a replay.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        state = (
            read_listings(session, version_path(root, batch_id - 1)) if batch_id else initial
        )
        moment = now(batch_id) if callable(now) else now
        write_snapshot(upsert_listings(state, batch, moment), root, batch_id)

    source = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .parquet(landed)
    )
    return (
        source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_fetches(
    spark: SparkSession, landed: str, store: ListingStore, checkpoint: str, files_per_batch: int = 1000,
) -> StreamingQuery:
    """S1 with J2-J4: apply the fetches that land below ``landed`` to the store, then stop.

    Files have the columns of FETCHED.  A micro-batch goes from the version of its number
    to the next one: served rows of good fetches are upserted or touched at the time of
    their fetch, and a company's latest outcome expires what was last refreshed before it,
    a day before it if the fetch was partial, or everything if its board is gone.  Nothing
    of this depends on the clock, and versions start at 0, which has to be there.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            outcomes = batch.filter("outcome")
            statuses = classify_fetch(outcomes, "fetched_at")
            rows = batch.filter("NOT coalesce(outcome, false)").select(*scraped_names(), "fetched_at")
            apply_fetches(store, batch_id, batch_id + 1, rows, statuses)
        finally:
            batch.unpersist()

    source = spark.readStream.schema(FETCHED).option("maxFilesPerTrigger", files_per_batch).parquet(landed)
    return (
        source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def scraped_names() -> list[str]:
    return [f.split()[0] for f in schemas.SCRAPED.split(", ")]


def latest_version(spark: SparkSession, root: str) -> str:
    """Path of the highest version below ``root``."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = files.Path(root)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    numbers = [
        int(s.getPath().getName().split("=", 1)[1])
        for s in system.listStatus(folder) if s.getPath().getName().startswith("version=")
    ]
    return version_path(root, max(numbers))
