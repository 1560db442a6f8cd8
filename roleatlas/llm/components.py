"""Connected components of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least of the node and its neighbours."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    hung = both.join(least, "a").filter("b > a")
    return hung.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.unionAll(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows ``id, class`` of every linked node; the class is the component's least id.

    ``links`` has columns ``a`` and ``b``.  Both steps reduce per task before they
    shuffle, so a node with very many links is no hot key, and the rounds grow with
    the logarithm of a component's width.  Each round is a table in the shared folder.
    """
    state = None
    links = materialize(links.filter("a <> b").distinct())
    while True:
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        state = mark
        links = materialize(small_star(large_star(links)))
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("class")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("class")).unionAll(roots)
