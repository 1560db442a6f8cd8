"""One ingestion pass: sanitise, upsert, touch, expire, count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fv
from ..functions.listings import has_content, is_sane
from ..functions.regex import text
from ..functions.text import clean_description, clean_location, scrub_nul
from ..functions.urls import clean_ats_url, is_garbage_url
from ..functions.urls import url_hash
from ..operators.state import (
    expiry_cutoffs, flag_expired, last_values, merge, merge_status, new_text, time_order, timestamp,
)
from ..session import lookup_join, materialize
from ..sources.companies import classify_fetch
from ..sources.snapshots import write_snapshot
from ..sources.store import ListingStore, text_digest

STATUS_COUNTS = ["companies_total", "scraped_ok", "partial", "stale_404", "timed_out", "empty"]
LISTING_COUNTS = [
    "listings_scraped", "listings_stored", "listings_new", "expired_normal", "expired_partial",
]


def status_counts(statuses: DataFrame) -> DataFrame:
    """Company counts of a run."""

    def count(c: Column, name: str) -> Column:
        return F.count_if(c).alias(name)

    status = F.col("status")
    return statuses.agg(
        F.count("*").alias("companies_total"),
        count(status == "ok", "scraped_ok"),
        count((status == "ok") & F.col("partial"), "partial"),
        count(status == "stale_404", "stale_404"),
        count(status == "timeout", "timed_out"),
        count(status == "empty", "empty"),
        count(status == "error", "errors"),
    )


def _listing_counts() -> list[Column]:
    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)

    return [
        total(F.col("n_served"), "listings_scraped"),
        total(F.col("n_sane"), "listings_stored"),
        total(F.col("_new"), "listings_new"),
        total(F.coalesce(F.col("_expired") == "normal", F.lit(False)), "expired_normal"),
        total(F.coalesce(F.col("_expired") == "partial", F.lit(False)), "expired_partial"),
    ]


def _by_url(served: DataFrame, at: str | None = None) -> DataFrame:
    """The batch cleaned and reduced to one row per canonical URL.

    Rows that are served but rejected keep their URL alive without giving values,
    so one aggregation feeds both the upsert and the touch.  With ``at``, the time of a
    row's fetch, later fetches win and the latest time is kept.
    """
    col = F.col
    rows = served.withColumn(
        "_sane", is_sane(col("url"), col("title"), col("description_raw"))
    ).withColumns({
        "title": scrub_nul(text(col("title"))),
        "company": scrub_nul(text(col("company"))),
        "description_raw": scrub_nul(clean_description(text(col("description_raw")))),
        "location": scrub_nul(clean_location(text(col("location")))),
        "remote_onsite": scrub_nul(text(col("remote_onsite"))),
        "posted_date": scrub_nul(text(col("posted_date"))),
        "source_domain": F.lit(fv.ATS_DOMAIN),
        "url": clean_ats_url(text(col("url"))),
    })
    valid = (
        col("_sane") & has_content(col("url"), col("title"), col("description_raw"))
        & ~is_garbage_url(col("url"))
    )
    order = None if at is None else time_order(rows, at)
    latest = {} if at is None else {at: col(at)}
    return last_values(rows, valid=valid, order=order, latest=latest, n_served=F.lit(1), n_sane=col("_sane"))


@dataclass
class IngestRun:
    """Lazy result of a pass: the next table version and the run's counts."""

    audited: DataFrame
    statuses: DataFrame

    @property
    def listings(self) -> DataFrame:
        return self.audited.filter("_kept").select(schemas.LISTING_COLUMNS)

    @property
    def stats(self) -> DataFrame:
        """E7 as one row; runs the pass.  ``write`` gets the counts for free."""
        listing = self.audited.agg(*_listing_counts())
        both = status_counts(self.statuses).unionByName(listing, allowMissingColumns=True)
        names = [*STATUS_COUNTS, *LISTING_COUNTS, "errors"]
        return both.agg(*[F.sum(c).alias(c) for c in names])

    def write(self, root: str, version: str | int) -> tuple[str, dict[str, int]]:
        """Write the next version; the counts are observed while it is written."""
        seen = Observation("ingest")
        observed = self.audited.observe(seen, *_listing_counts())
        kept = observed.filter("_kept").select(schemas.LISTING_COLUMNS)
        path = write_snapshot(kept, root, version)
        companies = status_counts(self.statuses).first().asDict()
        return path, {**companies, **seen.get}


def fetch_statuses(fetch_log: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """How each fetch went; of ``companies``, those without a row in the log are empty."""
    statuses = classify_fetch(fetch_log)
    if companies is None:
        return statuses
    silent = companies.select("company").distinct().join(fetch_log.select("company"), "company", "left_anti")
    silent = silent.select("company", F.lit("empty").alias("status"), F.lit(False).alias("partial"))
    return statuses.unionByName(silent, allowMissingColumns=True)


def run_ingest(
    state: DataFrame, batch: DataFrame, fetch_log: DataFrame, now, companies: DataFrame | None = None
) -> IngestRun:
    """Apply the boards' listings of one run to the stored table.

    ``batch`` is what the boards served (``company, seq`` and the scraped columns),
    ``fetch_log`` how each company's fetch went, ``now`` the start of the run.  Of
    ``companies``, those without a row in the log are counted as empty.
    Only the outer join on ``url`` shuffles stored listings; the expiry is a
    broadcast of the measured company list inside the same pass.
    """
    statuses = fetch_statuses(fetch_log, companies)
    ok = statuses.filter(F.col("status") == "ok").select("company")
    served = lookup_join(batch, ok, ["company"], "left_semi")
    merged = merge(state, _by_url(served), now)
    return IngestRun(flag_expired(merged, expiry_cutoffs(statuses, now)), statuses)


def ingest_version(
    store: ListingStore, version: int, into: int, batch: DataFrame, fetch_log: DataFrame, now,
    companies: DataFrame | None = None,
) -> dict[str, int]:
    """J5 on a store: the pass of :func:`run_ingest`, from ``version`` to the version ``into``.

    Stored rows are joined where they lie and only status rows are written anew; of the
    descriptions, those that changed are added, and no stored one is read.
    """
    at = timestamp(now)
    statuses = fetch_statuses(fetch_log, companies).withColumn("fetched_at", at)
    return apply_fetches(store, version, into, batch.withColumn("fetched_at", at), statuses)


def apply_fetches(
    store: ListingStore, version: int, into: int, rows: DataFrame, statuses: DataFrame
) -> dict[str, int]:
    """Upsert, touch and expire by fetches that each have a time of their own.

    ``rows`` is what boards served and ``statuses`` how the fetches went (``company,
    status, partial, fetched_at``); of several fetches of a company, rows count in order of
    time and the latest outcome decides about expiry.  The version's status rows are
    written last, so that a version without them does not count.
    """
    statuses = materialize(statuses.select("company", "status", "partial", "fetched_at"))
    fetches = statuses.filter("status = 'ok'").select("company", "fetched_at").distinct()
    served = lookup_join(rows, fetches, ["company", "fetched_at"], "left_semi")
    winners = materialize(_by_url(served, "fetched_at").withColumns({
        "url_hash": url_hash(F.col("url")), "text_digest": text_digest(F.col("description_raw")),
        "text_length": F.length("description_raw"),
    }))
    status = store.status(version)
    s, b = status.select("url", "text_digest").alias("s"), winners.filter("_valid").alias("b")
    brought = b.join(s, F.col("s.url") == F.col("b.url"), "left").filter(new_text())
    store.write_texts(brought.select("b.url", "b.url_hash", "b.description_raw"), into)

    last = statuses.groupBy("company").agg(
        *[F.max_by(c, "fetched_at").alias(c) for c in ("status", "partial")], F.max("fetched_at").alias("fetched_at")
    )
    cutoffs = expiry_cutoffs(last, F.col("fetched_at"))
    seen = Observation("ingest")
    audited = flag_expired(merge_status(status, winners, into), cutoffs).observe(seen, *_listing_counts())
    store.write_status(audited.filter("_kept"), into)
    return {**status_counts(last).first().asDict(), **seen.get}
