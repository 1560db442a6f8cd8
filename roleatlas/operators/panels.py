"""Groups, side panels, points and colors of a neighborhood (bounded per role)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.titles import panel_ok, shares_words
from ..functions.regex import strip
from ..session import materialize
from .topk import top_k


def group_counts(
    neighbors: DataFrame, min_size: int = fv.MIN_GROUP_SIZE, max_groups: int = fv.MAX_GROUPS
) -> DataFrame:
    """The largest groups per role; ties go to the one seen first."""
    counted = neighbors.groupBy("role", "grp").agg(
        F.count("*").alias("n"), F.min("rank").alias("first_rank"),
        F.avg("sim").alias("mean_sim"),
    )
    order = Window.partitionBy("role").orderBy(F.desc("n"), "first_rank")
    return (
        counted.filter(F.col("n") >= min_size)
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= max_groups)
    )


def also_near(
    neighbors: DataFrame, groups: DataFrame, size: int = fv.ALSO_NEAR_SIZE,
    exclude_named_groups: bool = True,
) -> DataFrame:
    """The best listing of each group that is not on the legend."""
    fit = neighbors.filter(panel_ok(F.col("grp"), F.col("title"), F.col("company")))
    fit = fit.withColumn("_key", F.lower("grp"))
    if exclude_named_groups:
        named = groups.select("role", F.lower("grp").alias("_key"))
        fit = fit.join(named, ["role", "_key"], "left_anti")
    first = Window.partitionBy("role", "_key").orderBy("rank")
    order = Window.partitionBy("role").orderBy("rank")
    return (
        fit.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
        .withColumn("position", F.row_number().over(order)).filter(F.col("position") <= size)
        .select(
            "role", "position", "title", "company",
            F.round("sim", fv.ALSO_NEAR_DIGITS).alias("sim"),
        )
    )


def farthest(
    plain: DataFrame, texts: DataFrame, pool: int = fv.FARTHEST_POOL, size: int = fv.FARTHEST_SIZE
) -> DataFrame:
    """The plainest listings far from a role.

    ``plain`` is ``role, url_hash, raw_score`` of listings with a plausible title, the
    center included: all of the searchable corpus, or those that hold each role's ``pool``
    lowest.  Only the pool gets its text.  It is cut before the word test, so a role can
    end up with fewer than ``size`` rows.
    """
    order = [F.col("raw_score"), F.col("url_hash")]
    far = materialize(top_k(plain, ["role"], order, pool, rank="_place")).join(texts, "url_hash")
    wordy = far.filter(shares_words(F.col("title"))).withColumn("_key", strip(F.lower("title")))
    first = Window.partitionBy("role", "_key").orderBy("_place")
    order = Window.partitionBy("role").orderBy("_place")
    return (
        wordy.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
        .withColumn("position", F.row_number().over(order)).filter(F.col("position") <= size)
        .select(
            "role", "position", "title", "company",
            F.round("raw_score", fv.FARTHEST_DIGITS).alias("sim"),
        )
    )


def center_sample(
    center: DataFrame, size: int = fv.MAX_CENTER_DOTS, seed: int = fv.SEED
) -> DataFrame:
    """At most ``size`` center listings, the same ones however data is laid out."""
    order = [F.md5(F.concat(F.lit(f"{seed}:"), F.col("url_hash").cast("string"))), F.col("url_hash")]
    return top_k(center, ["role"], order, size, rank="_place").drop("_place")


def viz_set(sample: DataFrame, neighbors: DataFrame, groups: DataFrame, labels: Column) -> DataFrame:
    """Center dots and the neighbors of legend groups, with display groups."""
    columns = ["role", "url_hash", "title", "company", "url", "grp", "is_center"]
    dots = sample.withColumn("grp", labels).withColumn("is_center", F.lit(True))
    near = neighbors.join(groups.select("role", "grp"), ["role", "grp"], "left_semi")
    near = near.withColumn("is_center", F.lit(False))
    return dots.select(columns).unionByName(near.select(columns))


def legend(groups: DataFrame, sample: DataFrame, labels: Column) -> DataFrame:
    """Legend rows in order, each with its color.

    The center is a row of its own (slot 0), so a group of the same name cannot
    overwrite its count.
    """
    center = sample.groupBy("role").agg(F.count("*").alias("n")).select(
        "role", labels.alias("grp"), "n", F.lit(0).alias("position"), F.lit(True).alias("is_center")
    )
    named = groups.select("role", "grp", "n", "position", F.lit(False).alias("is_center"))
    return assign_colors(center.unionByName(named))


def assign_colors(rows: DataFrame) -> DataFrame:
    """Slot 0 to the center, slots 1.. to the others in group order."""
    others = Window.partitionBy("role", "is_center").orderBy("position", "grp")
    slot = F.when(F.col("is_center"), 0).otherwise(F.row_number().over(others))
    palette = F.array(*[F.lit(c) for c in fv.PALETTE])
    order = Window.partitionBy("role").orderBy(F.desc("is_center"), F.desc("n"), "position", "grp")
    return rows.withColumn("slot", slot).select(
        "role", "grp", "n", "is_center", "slot",
        F.get(palette, F.pmod(F.col("slot"), F.lit(len(fv.PALETTE)))).alias("color"),
        F.row_number().over(order).alias("legend_order"),
    )
