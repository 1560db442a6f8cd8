"""Top-k per group that stays exact when a group is huge.

``row_number() <= k`` gathers a whole group in one task after Spark's per-task
pre-limit.  That is fine while k is a constant, with one more reduction step in
between; it is not when k grows with the data, as the prefetch width does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SALTS = 64
BINS = 4096
# Up to this many boundary rows per group are ranked by a plain window.
WINDOW_ROWS = 200_000


def top_k(
    df: DataFrame, group: list[str], order: list[Column], k: int, key: str = "url_hash",
    rank: str = "rank", bounded: bool = False,
) -> DataFrame:
    """First ``k`` rows per group, for a constant ``k``, ranked from 1.

    Two levels: each of ``SALTS`` slices of a group keeps its own first k, so the
    task that ranks the group sees ``SALTS * k`` rows however large it is.  Groups
    known to be ``bounded`` do without the first level.
    """
    if bounded:
        order_all = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(rank, F.row_number().over(order_all)).filter(F.col(rank) <= k)
    salt = F.pmod(F.xxhash64(key), F.lit(SALTS)).alias("_salt")
    slices = Window.partitionBy(*group, "_salt").orderBy(*order)
    first = (
        df.select("*", salt)
        .withColumn("_rank", F.row_number().over(slices)).filter(F.col("_rank") <= k)
        .drop("_salt", "_rank")
    )
    whole = Window.partitionBy(*group).orderBy(*order)
    return first.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= k)


def global_rank(df: DataFrame, order: list[Column], rank: str = "rank", weight: Column | None = None,
                slices: int | None = None) -> DataFrame:
    """Rank all rows from 1 without one task ever seeing them all.

    Rows are range-partitioned on the full sort key, each slice is ranked on its
    own and shifted by the sizes of the slices before it.  The sliced rows are
    written out first: sampled range bounds may differ between two executions.
    With ``weight`` a row counts that many times and gets its first rank.
    """
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    weight = F.lit(1) if weight is None else weight
    sliced = materialize(
        df.withColumn("_weight", weight.cast("long")).repartitionByRange(slices, *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    sizes = sliced.groupBy("_slice").agg(F.sum("_weight").alias("_size"))
    # One row per slice, at most `slices` rows.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("_upto", F.sum("_weight").over(inside))
        .join(F.broadcast(shifts), "_slice")
        .withColumn(rank, F.col("_shift") + F.col("_upto") - F.col("_weight") + 1)
        .drop("_slice", "_shift", "_upto", "_weight")
    )


def cut_at_rank(
    df: DataFrame, group: str, score: str, key: str, widths: dict, low: float = -1.0,
    high: float = 1.0, window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Rows among the first ``widths[group]`` by score (descending), then key.

    A histogram of the scores, aggregated map-side, finds per group the bin in
    which the cut falls.  Bins above it pass unranked; only the boundary bin is
    ranked: in a window when it is small, else by range partitioning, so that
    even a third of all rows tied on one score stays spread over the cluster.
    """
    if min(widths.values()) < 1:
        # A group that may keep nothing has no boundary bin and would pass whole.
        df = df.filter(_per_group(F.col(group), widths) > 0)
        widths = {g: w for g, w in widths.items() if w > 0}
        if not widths:
            return df
    position = F.floor((F.lit(high) - F.col(score)) / F.lit((high - low) / BINS))
    binned = df.withColumn("_bin", F.greatest(F.lit(0), F.least(F.lit(BINS), position)).cast("int"))
    histogram = binned.groupBy(group, "_bin").agg(F.count("*").alias("_n"))
    # At most groups * (BINS + 1) rows.
    running = Window.partitionBy(group).orderBy("_bin")
    width = _per_group(F.col(group), widths)
    boundary = (
        histogram.withColumn("_upto", F.sum("_n").over(running))
        .filter((F.col("_upto") >= width) & (F.col("_upto") - F.col("_n") < width))
        .select(group, "_bin", "_n", "_upto", (width - F.col("_upto") + F.col("_n")).alias("_need"))
        .collect()
    )
    if not boundary:
        return df
    bins = {r[group]: r["_bin"] for r in boundary}
    needs = {r[group]: r["_need"] for r in boundary}
    # A group that is not wider than its cut has no boundary and passes whole.
    edge = F.coalesce(_per_group(F.col(group), bins), F.lit(BINS + 1))
    order = [F.col(score).desc(), F.col(key)]
    if max(r["_upto"] for r in boundary) <= window_rows and len(boundary) == len(widths):
        ranked = binned.filter(F.col("_bin") <= edge).drop("_bin")
        whole = Window.partitionBy(group).orderBy(*order)
        return (
            ranked.withColumn("_rank", F.row_number().over(whole))
            .filter(F.col("_rank") <= width).drop("_rank")
        )
    above = binned.filter(F.col("_bin") < edge)
    at_edge = binned.filter(F.col("_bin") == edge)
    if max(r["_n"] for r in boundary) <= window_rows:
        ranked = at_edge.withColumn(
            "_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))
        )
    else:
        placed = global_rank(at_edge, [F.col(group), *order], "_place")
        starts, start = {}, 0
        for r in sorted(boundary, key=lambda r: r[group]):
            starts[r[group]] = start
            start += r["_n"]
        ranked = placed.withColumn(
            "_rank", F.col("_place") - _per_group(F.col(group), starts)
        ).drop("_place")
    kept = ranked.filter(F.col("_rank") <= _per_group(F.col(group), needs)).drop("_rank")
    return above.unionByName(kept).drop("_bin")


def _per_group(group: Column, values: dict) -> Column:
    """A constant per group, as a lookup expression over a handful of groups."""
    pairs = [F.lit(x) for g, v in values.items() for x in (g, int(v))]
    return F.element_at(F.create_map(*pairs), group)
