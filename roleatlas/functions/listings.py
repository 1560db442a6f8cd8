"""Row predicates and the sanitising projection over scraped listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fv
from .regex import strip, text
from .text import clean_description, clean_location, is_garbage_description
from .titles import is_aggregator_listing
from .urls import is_garbage_url


def has_content(url: Column, title: Column, description: Column) -> Column:
    """C4: a URL, and a title or a description worth storing."""
    return (text(url) != "") & (
        (strip(text(title)) != "")
        | (F.length(text(description)) > fv.STORED_CONTENT_MIN_LENGTH)
    )


def is_sane(url: Column, title: Column, description: Column) -> Column:
    """The three rejection rules, on the values as scraped."""
    return (
        (text(url) != "") & ~is_garbage_url(url)
        & ~is_aggregator_listing(title) & ~is_garbage_description(description)
    )


def sanitize(scraped: DataFrame) -> DataFrame:
    """Drop garbage rows, clean the text columns."""
    col = F.col
    kept = scraped.filter(is_sane(col("url"), col("title"), col("description_raw")))
    return kept.withColumns({
        "title": text(col("title")),
        "company": text(col("company")),
        "description_raw": clean_description(col("description_raw")),
        "location": clean_location(text(col("location"))),
        "remote_onsite": text(col("remote_onsite")),
        "posted_date": text(col("posted_date")),
        "source_domain": F.lit(fv.ATS_DOMAIN),
    })


def needs_vector(title: Column, description: Column, is_active: Column) -> Column:
    """C6, the row part: active, with some text to embed (title not trimmed)."""
    return is_active & (
        (F.length(title) > 0) | (F.length(description) > fv.STORED_CONTENT_MIN_LENGTH)
    )
