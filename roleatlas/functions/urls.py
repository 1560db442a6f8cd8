"""URL rules and the 63-bit URL key."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from . import fixed_values as fv
from .regex import bind, matches, remove, strip, text


def clean_ats_url(url: Column) -> Column:
    """B1: drop tracking parameters (and the ashby application page) per host."""

    def no_query(u: Column) -> Column:
        return remove(u, fv.QUERY_PATTERN)

    def on(u: Column, applies: Column, cleaned: Column) -> Column:
        return F.when(applies, cleaned).otherwise(u)

    def ashby(u: Column) -> Column:
        return on(
            u, u.contains(fv.ASHBY_HOST_MARK), no_query(remove(u, fv.APPLICATION_PATTERN))
        )

    def query_only(u: Column) -> Column:
        marked = (
            u.contains(fv.GREENHOUSE_HOST_MARK) | u.contains(fv.GREENHOUSE_ID_MARK)
            | u.contains(fv.LEVER_HOST_MARK)
            | (u.contains(fv.GOOGLE_HOST_MARK) & u.contains(fv.GOOGLE_CAREERS_MARK))
        )
        return on(u, marked, no_query(u))

    # A later rule sees what an earlier one left, so each stage is bound: written
    # out, the nested tests would repeat every stage many times over.
    linkedin = on(url, url.contains(fv.LINKEDIN_VIEW_MARK), no_query(url))
    return bind(linkedin, lambda u: bind(ashby(u), query_only))


def url_path_parts(url: Column) -> Column:
    """Path segments after trimming slashes; at least one, maybe empty."""
    bare = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")
    after_host = F.regexp_replace(bare, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?", "")
    path = F.regexp_extract(after_host, r"^[^?#]*", 0)
    return F.split(F.regexp_replace(path, r"^/+|/+\z", ""), "/")


def is_garbage_url(url: Column) -> Column:
    """A search, category or board page instead of one posting."""

    def rules(u: Column) -> Column:
        board_root = u.contains(fv.LEVER_HOST_MARK) & (F.size(url_path_parts(u)) < 2)
        team_page = u.contains(fv.TEAMS_URL_MARK) & ~matches(u, fv.JOB_PATH_PATTERN)
        return (
            u.contains(fv.SEARCH_URL_MARK) | u.contains(fv.CATEGORY_URL_MARK)
            | team_page | board_root | u.contains(fv.LEVER_DEMO_MARK)
        )

    return bind(F.lower(text(url)), rules)


def _digest(url: str | None) -> int | None:
    if url is None:
        return None
    raw = hashlib.blake2b(url.encode(), digest_size=fv.URL_HASH_DIGEST_BYTES).digest()
    return int.from_bytes(raw, "big") & fv.URL_HASH_MASK


@F.pandas_udf(LongType())
def url_hash(urls: pd.Series) -> pd.Series:
    """63-bit key of a canonical URL.  Spark has no such digest built in."""
    return pd.Series([_digest(u) for u in urls], dtype="Int64")


def url_host(url: Column) -> Column:
    """Host part of an http(s) URL."""
    return F.regexp_extract(text(strip(url)), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
