"""Exact deduplication by skew-safe combining of full contents (native)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE, col, keep_ids


def normalized(text: Column) -> Column:
    """The text with each run of white space as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, salts: int = 32,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    Texts are equal when they are identical after :func:`normalized`.  Each task
    first combines its own equal texts (the partial side of the aggregation, so a
    group that fills a third of the table is one row per task and salt), then the
    groups of one digest and salt are merged, then the winners of the salts.  All
    three group by the text itself beside its digest, so two texts that share a
    digest stay apart.  Only digests go back to the rows; rows whose digest stands
    for several texts, if there are any, are told apart by their text.

    Nulls: a null text is empty; a null id never wins unless all ids of its group
    are null.  A row is known by its id: rows that repeat the winner's id and text
    are all kept.  No rows give no rows; other columns are not looked at.
    """
    keyed = docs.select(col(id_col).alias("id"), normalized(col(text_col)).alias("content"))
    keyed = keyed.withColumn("digest", digest(F.col("content")))
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    salted = (
        keyed.groupBy("digest", salt.alias("salt"), "content")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    groups = (
        salted.repartition("digest").groupBy("digest", "content")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    )
    winners = materialize(
        groups.groupBy("digest").agg(
            F.count(F.lit(1)).alias("contents"), F.min("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
        )
    )
    clashes = winners.filter("contents > 1").select("digest")
    plain = winners.filter("contents = 1").drop("contents")
    found = keyed.drop("content").join(plain, "digest")
    if not clashes.isEmpty():
        told = groups.join(clashes, "digest")
        found = found.unionByName(keyed.join(told, ["digest", "content"]).drop("content"))
    return found.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns."""
    dropped = exact_groups(docs, id_col, text_col).filter(~F.col("kept")).select(id_col)
    return keep_ids(docs, materialize(dropped.distinct()), id_col)
