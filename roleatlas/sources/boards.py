"""Listings out of landed job-board payloads.

A payload table has one row per response: ``slug string, body string``.  Parsing
is ``from_json`` with a fixed schema and ``posexplode``, so it runs where the
payloads are read, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.regex import strip, text
from ..functions.text import (
    ashby_remote, flatten_sections, html_text, lever_remote, posted_date, strip_html,
)
from ..functions import fixed_values as fv
from ..functions.titles import is_aggregator_listing
from ..session import lookup_join
from .companies import route_boards


def _first_set(*columns: Column) -> Column:
    """The first value that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[F.when(c != "", c) for c in columns], F.lit(""))


def _jobs(payloads: DataFrame, array: Column, extra: list[str] | None = None) -> DataFrame:
    keep = ["slug", *(extra or [])]
    return payloads.select(*keep, F.posexplode(array).alias("seq", "job"))


def _listings(jobs: DataFrame, **columns: Column) -> DataFrame:
    return jobs.select(
        "slug", F.col("seq").cast("long").alias("seq"),
        *[text(columns[c]).alias(c) for c in schemas.SCRAPED_COLUMNS],
    )


def greenhouse_listings(payloads: DataFrame) -> DataFrame:
    """A2."""
    parsed = F.from_json("body", schemas.GREENHOUSE)
    job = F.col("job")
    place = job["location"]
    location = F.when(place.startswith("{"), F.get_json_object(place, "$.name")).otherwise(place)
    return _listings(
        _jobs(payloads, parsed["jobs"]),
        title=job["title"],
        url=job["absolute_url"],
        description_raw=html_text(job["content"]),
        location=location,
        remote_onsite=F.lit(""),
        posted_date=job["first_published"],
    )


def lever_listings(payloads: DataFrame) -> DataFrame:
    """A3: the body must be an array, else the board has no postings."""
    array = F.when(
        F.json_array_length("body").isNotNull(), F.from_json("body", schemas.LEVER)
    )
    job = F.col("job")
    title = strip(text(job["text"]))
    built = F.concat(F.lit(fv.LEVER_POSTING_URL), F.col("slug"), F.lit("/"), text(job["id"]))
    categories = job["categories"]
    location = F.when(categories.startswith("{"), F.get_json_object(categories, "$.location"))
    listings = _listings(
        _jobs(payloads, array),
        title=title,
        url=_first_set(job["hostedUrl"], built),
        description_raw=_first_set(
            job["descriptionPlain"], job["description"], flatten_sections(job["lists"])
        ),
        location=location,
        remote_onsite=lever_remote(job["workplaceType"]),
        posted_date=posted_date(job["createdAt"]),
    )
    return listings.filter(~is_aggregator_listing(F.col("title")))


def ashby_listings(payloads: DataFrame) -> DataFrame:
    """A4."""
    parsed = F.from_json("body", schemas.ASHBY)
    job = F.col("job")
    built = F.when(
        job["id"] != "", F.concat(F.lit(fv.ASHBY_POSTING_URL), F.col("slug"), F.lit("/"), job["id"])
    )
    return _listings(
        _jobs(payloads, parsed["jobs"]),
        title=job["title"],
        url=_first_set(job["jobUrl"], job["applyUrl"], built),
        description_raw=_first_set(job["descriptionPlain"], html_text(job["descriptionHtml"])),
        location=_first_set(job["locationName"], job["location"]),
        remote_onsite=ashby_remote(job["isRemote"], job["workplaceType"]),
        posted_date=posted_date(job["publishedAt"]),
    )


def workday_listings(
    pages: DataFrame, details: DataFrame, known_urls: DataFrame | None = None
) -> DataFrame:
    """A5: list pages (``slug, base_url, offset, body``) with their detail payloads.

    ``details`` is ``url, body``.  A known URL keeps its row but gets no
    description, as its detail page would not have been fetched again.
    """
    site = F.regexp_extract("slug", r"(?s)^[^/]*/(.*)\z", 1)
    parsed = F.from_json("body", schemas.WORKDAY_PAGE)
    postings = _jobs(
        pages.filter(F.col("slug").contains("/")), parsed["jobPostings"], ["base_url", "offset"]
    )
    job = F.col("job")
    path = text(job["externalPath"])
    listed = postings.select(
        "slug", (F.col("offset") + F.col("seq")).alias("seq"), text(job["title"]).alias("title"),
        F.when(path != "", F.concat(F.col("base_url"), F.lit("/"), site, path))
        .otherwise("").alias("url"),
        # Nested values are not places.
        F.when(job["locationsText"].rlike(r"^[\[{]"), "")
        .otherwise(text(job["locationsText"])).alias("location"),
        text(job["postedOn"]).alias("posted_date"),
    )
    if known_urls is not None:
        details = details.join(known_urls.select("url").distinct(), "url", "left_anti")
    markup = F.from_json("body", schemas.WORKDAY_DETAIL)["jobPostingInfo"]["jobDescription"]
    described = (
        details.select(F.col("url").alias("_key"), strip_html(markup).alias("description_raw"))
        .groupBy("_key").agg(F.max("description_raw").alias("description_raw"))
    )
    # Postings without a path have nothing to look up; giving each its own key
    # keeps them from piling up in the task of the empty string.
    lone = F.concat_ws(" ", F.lit("none"), "slug", "seq")
    joined = listed.withColumn(
        "_key", F.when(F.col("url") != "", F.col("url")).otherwise(lone)
    ).join(described, "_key", "left")
    return joined.select(
        "slug", "seq", "title", "url", text(F.col("description_raw")).alias("description_raw"),
        "location", F.lit("").alias("remote_onsite"), "posted_date",
    )


def scraped_batch(
    companies: DataFrame, payloads: DataFrame, workday_details: DataFrame,
    known_urls: DataFrame | None = None,
) -> DataFrame:
    """All boards' listings with the company that owns each board.

    ``payloads`` is ``kind, slug, body, base_url, offset``; a board that no
    company is routed to yields nothing.
    """
    parts = []
    for kind, parse in [
        ("greenhouse", greenhouse_listings), ("lever", lever_listings), ("ashby", ashby_listings),
    ]:
        parts.append((kind, parse(payloads.filter(F.col("kind") == kind))))
    pages = payloads.filter(F.col("kind") == "workday")
    parts.append(("workday", workday_listings(pages, workday_details, known_urls)))
    union = None
    for kind, rows in parts:
        rows = rows.withColumn("kind", F.lit(kind))
        union = rows if union is None else union.unionByName(rows)
    routes = route_boards(companies)
    return lookup_join(union, routes, ["kind", "slug"], "inner").select(
        "company", "seq", *schemas.SCRAPED_COLUMNS
    )
