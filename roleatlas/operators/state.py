"""Maintenance of the listings table: upsert, touch, expire.

Parquet has no MERGE, so every operator returns the next version of the table.
The full outer join on ``url`` is the only shuffle of the stored listings; keep
the table bucketed by ``url`` (``save_bucketed``) and that one goes away too.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fv
from ..functions.listings import has_content
from ..functions.regex import text
from ..functions.text import scrub_nul
from ..functions.urls import clean_ats_url, is_garbage_url, url_hash
from ..session import lookup_join, materialize
from ..sources.store import STATUS_COLUMNS, TEXT_COLUMNS

# Columns a refresh may overwrite.
REFRESHED = [
    "title", "company", "description_raw", "location", "remote_onsite", "posted_date",
]


def timestamp(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def storable(batch: DataFrame) -> DataFrame:
    """What of a batch may be stored: content check, clean URL, no NULs."""
    col = F.col
    kept = batch.filter(has_content(col("url"), col("title"), col("description_raw")))
    kept = kept.withColumn("url", clean_ats_url(col("url"))).filter(~is_garbage_url(col("url")))
    return kept.withColumns({c: scrub_nul(text(col(c))) for c in [*REFRESHED, "source_domain"]})


def packed(*parts: tuple[Column, int]) -> Column:
    """Whole numbers of so many bits, 126 at most, one after another in a number.

    A decimal is of fixed width, so an aggregate that looks for the greatest can hash.
    """
    total = F.lit(Decimal(0)).cast("decimal(38,0)")
    for number, bits in parts:
        total = total * F.lit(Decimal(2**bits)) + number.cast("decimal(38,0)")
    return total


def top_bits(c: Column, n: int) -> tuple[Column, int]:
    return F.shiftrightunsigned(c, 64 - n), n


def sequence() -> tuple[Column, int]:
    return F.coalesce(F.col("seq"), F.lit(0)).cast("decimal(38,0)") + F.lit(Decimal(2**63)), 64


def batch_order(batch: DataFrame) -> Column:
    """A total order of the rows of one URL: company, sequence, content.

    Companies are ordered by a hash, which matters for a URL that several of them serve.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c in batch.columns])
    return packed(top_bits(F.xxhash64("company"), 30), sequence(), top_bits(content, 32))


def time_order(batch: DataFrame, at: str) -> Column:
    """A total order of the rows of one URL: time of the fetch, sequence, content."""
    content = F.xxhash64(*[F.col(f"`{c}`") for c in batch.columns])
    return packed((F.unix_millis(at), 42), sequence(), top_bits(content, 20))


def last_values(
    batch: DataFrame, key: str = "url", valid: Column | None = None, order: Column | None = None,
    latest: dict[str, Column] | None = None, **counts: Column,
) -> DataFrame:
    """per key, the last non-empty value of each column, sums of ``counts`` and maxima of ``latest``.

    Row numbers decide first: an aggregate over fixed-width numbers, reduced before its
    shuffle, finds for each key and column the row that gives the value.  Values are then
    taken from these rows alone, nearly always one per key; no aggregate sorts or carries
    text.  Rows that are not ``valid`` only keep their key alive.  The rows are written
    first, since their numbers have to hold.
    """
    latest = latest or {}
    valid = F.lit(True) if valid is None else valid
    taken = [*REFRESHED, "source_domain"]
    rows = materialize(batch.select(
        key, *taken, valid.alias("_valid"), *[c.cast("long").alias(f"_n_{n}") for n, c in counts.items()],
        *[c.alias(f"_n_{n}") for n, c in latest.items()],
        *[(valid & (F.col(c) != "")).alias(f"_gives_{c}") for c in REFRESHED],
        (batch_order(batch) if order is None else order).alias("_order"),
        F.monotonically_increasing_id().alias("_row"),
    ))

    def last(c: str) -> Column:
        return F.max_by("_row", F.when(F.col(f"_gives_{c}"), F.col("_order"))).alias(f"_{c}")

    first = F.min_by("_row", F.when(F.col("_valid"), F.col("_order"))).alias("_source_domain")
    wins = rows.groupBy(key).agg(
        *[last(c) for c in REFRESHED], first, F.min("_row").alias("_any"), F.max("_valid").alias("_valid"),
        *[F.sum(f"_n_{n}").alias(n) for n in counts], *[F.max(f"_n_{n}").alias(n) for n in latest],
    )
    # The row that gives the description is the base, so only short values come from elsewhere.
    short = [c for c in taken if c != "description_raw"]
    places = [F.col(f"_{c}") for c in ["description_raw", *short]]
    wins = materialize(wins.withColumn("_base", F.coalesce(*places, "_any")))
    given = F.filter(
        F.array(*[
            F.when((F.col(f"_{c}") == F.col("_row")) & (F.col("_row") != F.col("_base")),
                   F.struct(F.lit(c).alias("key"), F.col(c).alias("value")))
            for c in short
        ]),
        lambda e: e.isNotNull(),
    )
    # Few keys take values from several rows.
    apart = F.lit(False)
    for c in short:
        apart = apart | F.coalesce(F.col(f"_{c}") != F.col("_base"), F.lit(False))
    several = wins.filter(apart).select(key, "_base", *[f"_{c}" for c in short])
    pieces = lookup_join(rows.select(key, "_row", *short), several, [key], "inner").select(key, F.inline(given))
    patches = materialize(pieces.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("_patch")
    ))
    if patches.isEmpty():
        wins = wins.withColumn("_patch", F.lit(None).cast("map<string,string>"))
    else:
        wins = materialize(lookup_join(wins, patches, [key], "left"))
    # Descriptions move once at most, when all else is known.
    base = lookup_join(rows.select(key, "_row", *taken), wins, [key], "inner").filter("_row = _base")

    def value(c: str) -> Column:
        own = F.when(F.col(f"_{c}") == F.col("_row"), F.col(c))
        return F.coalesce(own, F.element_at("_patch", c), F.lit("")).alias(c)

    domain = F.coalesce(
        F.when(F.col("_source_domain") == F.col("_row"), F.col("source_domain")),
        F.element_at("_patch", "source_domain"),
    ).alias("source_domain")
    return base.select(key, *[value(c) for c in REFRESHED], domain, "_valid", *counts, *latest)


def merge(state: DataFrame, winners: DataFrame, now) -> DataFrame:
    """State after a batch, plus audit columns ``_new`` and the counts of ``winners``.

    ``winners`` is unique by URL.  One without a valid row only touches a stored
    listing and never creates one.
    """
    now = timestamp(now)
    # Hashing here means that only the batch's URLs reach Python.
    batch = winners.withColumn("_hash", url_hash(F.col("url"))).withColumn("_served", F.lit(True))
    counts = [c for c in winners.columns if c.startswith("n_")]
    s, b = state.alias("s"), batch.alias("b")
    joined = s.join(b, F.col("s.url") == F.col("b.url"), "full_outer")
    stored = F.col("s.url").isNotNull()
    valid = F.coalesce(F.col("b._valid"), F.lit(False))
    served = F.coalesce(F.col("b._served"), F.lit(False))

    def refreshed(c: str) -> Column:
        # The test on `valid` matters for a URL that was served but not kept.
        new = F.when(valid & (F.col(f"b.{c}") != ""), F.col(f"b.{c}"))
        return F.coalesce(new, F.col(f"s.{c}"), F.lit("")).alias(c)

    columns = {
        "url": F.coalesce("s.url", "b.url"),
        "url_hash": F.coalesce("s.url_hash", "b._hash"),
        "seniority": F.coalesce("s.seniority", F.lit("")),
        "source_domain": F.coalesce("s.source_domain", "b.source_domain", F.lit("")),
        "scraped_at": F.coalesce(F.col("s.scraped_at"), now),
        "last_refreshed": F.when(served, now).otherwise(F.col("s.last_refreshed")),
        "is_active": valid | F.coalesce(F.col("s.is_active"), F.lit(False)),
    }
    out = [
        refreshed(c) if c in REFRESHED else columns[c].alias(c) for c in schemas.LISTING_COLUMNS
    ]
    # Kept rows are flagged, not filtered: the counts of dropped URLs still matter.
    return joined.select(
        *out, (~stored & valid).alias("_new"), (stored | valid).alias("_kept"),
        *[F.coalesce(F.col(f"b.{c}"), F.lit(0)).alias(c) for c in counts],
    )


def merge_status(status: DataFrame, winners: DataFrame, version: int) -> DataFrame:
    """As :func:`merge` for the status rows of a store, without any description.

    ``winners`` has ``fetched_at``, ``url_hash``, ``text_digest`` and ``text_length``; a
    description other than the stored one belongs to ``version``.
    """
    counts = [c for c in winners.columns if c.startswith("n_")]
    s, b = status.alias("s"), winners.drop("description_raw").withColumn("_served", F.lit(True)).alias("b")
    joined = s.join(b, F.col("s.url") == F.col("b.url"), "full_outer")
    stored = F.col("s.url").isNotNull()
    valid = F.coalesce(F.col("b._valid"), F.lit(False))
    now = F.col("b.fetched_at")
    text = valid & new_text()

    def refreshed(c: str) -> Column:
        return F.coalesce(F.when(valid & (F.col(f"b.{c}") != ""), F.col(f"b.{c}")), F.col(f"s.{c}"), F.lit(""))

    def of_text(c: str, own: Column) -> Column:
        return F.when(text, own).otherwise(F.col(f"s.{c}"))

    columns = {c: refreshed(c) for c in REFRESHED if c != "description_raw"} | {
        "url": F.coalesce("s.url", "b.url"), "url_hash": F.coalesce("s.url_hash", "b.url_hash"),
        "seniority": F.coalesce("s.seniority", F.lit("")),
        "source_domain": F.coalesce("s.source_domain", "b.source_domain", F.lit("")),
        "scraped_at": F.coalesce(F.col("s.scraped_at"), now),
        "last_refreshed": F.coalesce(F.greatest(now, F.col("s.last_refreshed")), F.col("s.last_refreshed")),
        "is_active": valid | F.coalesce(F.col("s.is_active"), F.lit(False)),
        "text_digest": F.coalesce(of_text("text_digest", F.col("b.text_digest")), F.lit("")),
        "text_length": F.coalesce(of_text("text_length", F.col("b.text_length")), F.lit(0)),
        "text_version": of_text("text_version", F.lit(version).cast("long")),
    }
    return joined.select(
        *[columns[c].alias(c) for c in [*STATUS_COLUMNS, *TEXT_COLUMNS]],
        (~stored & valid).alias("_new"), (stored | valid).alias("_kept"),
        *[F.coalesce(F.col(f"b.{c}"), F.lit(0)).alias(c) for c in counts],
    )


def new_text() -> Column:
    """Whether a winner ``b`` brings another description than the stored row ``s`` has."""
    return (F.col("b.text_digest") != "") & (F.col("b.text_digest") != F.coalesce("s.text_digest", F.lit("")))


def counted(df: DataFrame, seen: Observation | None, **flags: Column) -> DataFrame:
    """``df``, whose next action also counts the rows that have each flag."""
    if seen is None:
        return df
    return df.observe(seen, *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])


def upsert_listings(
    state: DataFrame, batch: DataFrame, now, seen: Observation | None = None
) -> DataFrame:
    """Insert or refresh; empty incoming values never clobber stored ones.

    ``seen`` gets the number of ``inserted`` listings when the result is used.
    """
    merged = counted(merge(state, last_values(storable(batch)), now), seen, inserted=F.col("_new"))
    return merged.filter("_kept").select(schemas.LISTING_COLUMNS)


def new_listing_count(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Distinct new URLs a batch would insert."""
    urls = storable(batch).select("url").distinct()
    return urls.join(state.select("url"), "url", "left_anti").agg(F.count("*").alias("n_new"))


def collapsed_urls(batch: DataFrame) -> DataFrame:
    """How many distinct scraped URLs share each canonical one, where more than one."""
    pairs = batch.select(clean_ats_url(F.col("url")).alias("url"), F.col("url").alias("_raw"))
    counted = pairs.groupBy("url").agg(F.countDistinct("_raw").alias("n_urls"))
    return counted.filter("n_urls > 1")


def touch_refreshed(state: DataFrame, urls: DataFrame, ts) -> DataFrame:
    """Bump ``last_refreshed`` of every served URL; does not reactivate.

    ``state`` may be whole listings or the narrow status rows of a store, here and below.
    """
    served = (
        urls.filter(text(F.col("url")) != "")
        .select(clean_ats_url(F.col("url")).alias("url")).distinct()
        .withColumn("_served", F.lit(True))
    )
    bumped = F.when(F.col("_served"), timestamp(ts)).otherwise(F.col("last_refreshed"))
    return (
        state.join(served, "url", "left").withColumn("last_refreshed", bumped).select(state.columns)
    )


def flag_expired(state: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Mark expiry against ``company, cutoff, kind``; ``_expired`` holds the kind."""
    joined = lookup_join(state, cutoffs, ["company"], "left")
    gone = (
        F.col("is_active") & (F.col("source_domain") == fv.ATS_DOMAIN)
        & (F.col("last_refreshed") < F.col("cutoff"))
    )
    return (
        joined.withColumn("_expired", F.when(gone, F.col("kind")))
        .withColumn("is_active", F.col("is_active") & F.col("_expired").isNull())
        .drop("cutoff", "kind")
    )


def expire_unrefreshed(
    state: DataFrame, companies: DataFrame, cutoff, seen: Observation | None = None
) -> DataFrame:
    """Deactivate the companies' listings last refreshed before ``cutoff``.

    ``seen`` gets the number of ``expired`` listings when the result is used.
    """
    cutoffs = companies.select("company").distinct().select(
        "company", timestamp(cutoff).alias("cutoff"), F.lit("normal").alias("kind")
    )
    flagged = counted(flag_expired(state, cutoffs), seen, expired=F.col("_expired").isNotNull())
    return flagged.select(state.columns)


END_OF_TIME = "9999-12-31 00:00:00"


def deactivate_company(
    state: DataFrame, companies: DataFrame, seen: Observation | None = None
) -> DataFrame:
    """Every active board listing of these companies goes off; counted as ``expired``."""
    return expire_unrefreshed(state, companies, END_OF_TIME, seen)


def expiry_cutoffs(statuses: DataFrame, now) -> DataFrame:
    """Per company the time before which an unrefreshed listing is gone.

    Timed-out, failed and empty companies get none, so they stay untouched.
    """
    now = timestamp(now)
    grace = now - F.expr(f"INTERVAL {fv.PARTIAL_GRACE_HOURS} HOURS")
    kind = (
        F.when(F.col("status") == "stale_404", "stale")
        .when((F.col("status") == "ok") & F.col("partial"), "partial")
        .when(F.col("status") == "ok", "normal")
    )
    cutoff = (
        F.when(kind == "stale", timestamp(END_OF_TIME)).when(kind == "partial", grace).otherwise(now)
    )
    return statuses.select("company", cutoff.alias("cutoff"), kind.alias("kind")).filter(
        "kind IS NOT NULL"
    )


def has_description(state: DataFrame, urls: DataFrame) -> DataFrame:
    """Those of ``urls`` that are stored with a real description."""
    described = F.length("description_raw") > fv.KNOWN_CONTENT_MIN_LENGTH
    asked = urls.select("url").distinct()
    return state.filter(described).select("url").join(asked, "url", "left_semi")
