"""Counts and reports over the two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.titles import normalize_title

# Sketches of 2**14 cells: a standard error of 0.8 %.
SKETCH_BITS = 14


def count_active(listings: DataFrame) -> DataFrame:
    """E1."""
    return listings.filter("is_active").agg(F.count("*").alias("n_active"))


def count_embeddings(vectors: DataFrame) -> DataFrame:
    """E2."""
    return vectors.agg(F.count("*").alias("n_vectors"))


def title_collapse_report(listings: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct raw titles against distinct groups.

    Each title is normalised once, whatever the number of its listings.  The
    approximate form keeps a fixed-size sketch per task instead.
    """
    titles = listings.select("title")
    if approximate:
        pair = titles.select("title", normalize_title(F.col("title")).alias("grp"))
        return pair.agg(
            F.approx_count_distinct("title").alias("n_titles"),
            F.approx_count_distinct("grp").alias("n_groups"),
        )
    distinct = titles.distinct().select("title", normalize_title(F.col("title")).alias("grp"))
    groups = distinct.groupBy("grp").agg(F.count("title").alias("n"))
    return groups.agg(
        F.sum("n").alias("n_titles"), F.count("grp").alias("n_groups"),
        F.coalesce(F.sum(F.when(F.col("grp").isNull(), F.col("n"))), F.lit(0)).alias("n_ungrouped"),
    )


def title_sketches(listings: DataFrame, version: int) -> DataFrame:
    """E9 of one version as a row: sketches of its distinct titles and groups.

    Sketches of versions, or of shares of one, are kept and merged later, so the report
    of a growing table reads each listing once.  Each title is normalised once.
    """
    distinct = listings.select("title").distinct().select("title", normalize_title(F.col("title")).alias("grp"))
    return distinct.agg(
        F.hll_sketch_agg("title", SKETCH_BITS).alias("titles"), F.hll_sketch_agg("grp", SKETCH_BITS).alias("groups"),
    ).select(F.lit(version).cast("long").alias("version"), "titles", "groups")


def collapse_of_sketches(sketches: DataFrame) -> DataFrame:
    """E9 over all versions of ``sketches``: estimated distinct titles and groups."""
    return sketches.agg(
        F.hll_sketch_estimate(F.hll_union_agg("titles")).alias("n_titles"),
        F.hll_sketch_estimate(F.hll_union_agg("groups")).alias("n_groups"),
    )
