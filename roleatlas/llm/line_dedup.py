"""Removal of lines that spread over many sites (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import col, fresh

SITES = 8
# Sketches of 2**12 registers have a relative error below 2 % (and are exact for few sites);
# lines whose estimate is within this share of the threshold are counted exactly.
LOG_REGISTERS = 12
MARGIN = 0.25


def line_key(line: Column) -> Column:
    """128 bits of hash of a line without blanks at its ends."""
    trimmed = F.btrim(line, F.lit(" \t\r"))
    return F.struct(F.xxhash64(trimmed).alias("h1"), F.xxhash64(F.lit("line"), trimmed).alias("h2"))


def site_key(site: Column) -> Column:
    """A site as text; a null site is one of its own, unlike any text."""
    return F.coalesce(F.concat(F.lit("s"), site.cast("string")), F.lit(""))


def line_keys(text: Column) -> Column:
    """Keys of a text's distinct lines that aren't blank."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\r"))) > 0)
    return F.array_distinct(F.transform(lines, line_key))


def spread_lines(docs: DataFrame, text_col: str, site_col: str, sites: int) -> DataFrame:
    """``h1, h2`` of the lines that stand on at least ``sites`` distinct sites.

    Every line's sites are sketched per task and the sketches merged.  Lines that
    the sketch puts clearly above the threshold are taken, those clearly below left;
    those near it get an exact count of distinct sites.
    """
    lines = docs.select(
        site_key(col(site_col)).alias("site"), F.explode(line_keys(col(text_col))).alias("line")
    ).select("site", "line.h1", "line.h2")
    sketched = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sketch"))
    estimate = materialize(
        sketched.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("about"))
        .filter(F.col("about") >= (1 - MARGIN) * sites)
    )
    sure = estimate.filter(F.col("about") > (1 + MARGIN) * sites).select("h1", "h2")
    near = estimate.filter(F.col("about") <= (1 + MARGIN) * sites).select("h1", "h2")
    counted = lines.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2", "site").agg(F.lit(1))
    exact = counted.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= sites)
    return sure.unionAll(exact.select("h1", "h2"))


def drop_spread_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
    sites: int = SITES,
) -> DataFrame:
    """``docs`` with ``text_col`` cleaned, and ``n_lines`` and ``n_removed`` appended.

    A line is what stands between line feeds.  Lines that, but for blanks at their
    ends, stand on at least ``sites`` distinct sites are removed wherever they occur;
    blank lines stay.  Which lines go is decided once; the texts are cleaned by a join of
    each text's own removed lines, so no line, however frequent, is a group of texts.

    Nulls: a null text stays null with 0 lines; an empty text is one blank line; a null
    site is a site of its own; rows are told apart by their id, and rows that repeat an
    id share what is removed.  No rows give no rows.  Names already taken get
    underscores in front.
    """
    gone, n_lines, n_removed, own = fresh(docs, "_gone", "n_lines", "n_removed", "_own")
    spread = materialize(spread_lines(docs, text_col, site_col, sites))
    lines = docs.select(
        col(id_col).alias(own), F.explode(line_keys(col(text_col))).alias("line")
    ).select(own, "line.h1", "line.h2")
    found = lines.join(spread, ["h1", "h2"]).groupBy(own).agg(
        F.collect_set(F.struct("h1", "h2")).alias(gone)
    )
    joined = docs.join(found, col(id_col).eqNullSafe(col(own)), "left")
    parts = F.split(col(text_col), "\n", -1)
    kept = F.when(col(gone).isNull(), parts).otherwise(
        F.filter(parts, lambda x: ~F.array_contains(col(gone), line_key(x)))
    )
    return joined.select(
        *[(F.array_join(kept, "\n") if c == text_col else col(c)).alias(c) for c in docs.columns],
        F.when(col(text_col).isNull(), 0).otherwise(F.size(parts)).alias(n_lines),
        F.when(col(text_col).isNull(), 0).otherwise(F.size(parts) - F.size(kept)).alias(n_removed),
    )
