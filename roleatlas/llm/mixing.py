"""Mixing sources to target weights by repeating documents (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.topk import global_rank
from ..session import materialize
from .common import WORD, col, fresh


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str, key: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the key alone (32 bits of MD5)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Give ``source`` rows the weights of ``cycle``, in code point order, null last."""
    marked = sources.withColumn("last", F.col("source").isNull())
    ranked = global_rank(marked, [F.col("last"), F.col("source")], "place")
    pick = F.element_at(
        F.array(*[F.lit(w) for w in cycle]),
        F.pmod(F.col("place") - 1, F.lit(len(cycle))).cast("int") + 1,
    )
    return ranked.select("source", "source_size", pick.cast("long").alias("weight"))


def source_targets(sources: DataFrame, cap: int = 3) -> DataFrame:
    """Targets of ``(source, source_size, weight)`` rows: ``target`` and ``rate``.

    The targets share the total size by weight; one that would pass ``cap`` times
    its source's size stops there, and what it leaves is shared anew by weight until
    none is above.  Each round is one aggregation to three numbers, whatever the
    number of sources; a round without a newly stopped source is the last.
    """
    sources = materialize(sources)
    size, weight = F.col("source_size"), F.col("weight")
    level, stopped = None, -1
    while True:
        full = F.lit(False) if level is None else (cap * size).cast("double") <= F.lit(level) * weight
        row = sources.agg(
            F.sum(size).alias("total"), F.sum(F.when(full, 1).otherwise(0)).alias("stopped"),
            F.sum(F.when(full, cap * size).otherwise(0)).alias("used"),
            F.sum(F.when(full, 0).otherwise(weight)).alias("open"),
        ).first()
        if row["stopped"] is None or row["stopped"] == stopped or not row["open"]:
            break
        stopped = row["stopped"]
        level = (row["total"] - row["used"]) / row["open"]
    level = 0.0 if level is None else level
    target = F.least((cap * size).cast("double"), F.lit(level) * weight)
    return sources.withColumn("target", target).withColumn(
        "rate", F.when(size > 0, target / size).otherwise(0.0)
    )


def mixing_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: str = "mix",
) -> DataFrame:
    """``docs`` with its words (``size``), its source's ``source_size`` and ``target``, and ``copies``.

    A document is taken floor(rate) times, and once more with the probability of the
    rate's fraction, drawn from a hash of its id: reruns agree, and no document
    passes ``cap`` copies.  Sources are reduced per task before they are shuffled,
    and the few rows of rates are joined by Spark's own choice of join, so a source
    with a third of all rows is neither gathered nor moved as one group.

    Nulls: a null text has size 0, a null source is a source of its own and sorts
    last, a null id draws as the empty id.  A source without words has target 0 and
    its documents no copies.  Repeated ids draw alike.  No rows give no rows.  Added
    columns whose name is taken get underscores in front; the order is always size,
    source_size, target, copies, after the columns of ``docs``.
    """
    size, source_size, target, copies, key = fresh(
        docs, "size", "source_size", "target", "copies", "_source"
    )
    sized = docs.withColumn(size, word_count(col(text_col)))
    sources = sized.groupBy(col(source_col).alias("source")).agg(F.sum(col(size)).alias("source_size"))
    targets = source_targets(cyclic_weights(sources, cycle), cap).select(
        F.col("source").alias(key), F.col("source_size").alias(source_size),
        F.col("target").alias(target), F.col("rate").alias(copies),
    )
    joined = sized.join(targets, col(source_col).eqNullSafe(col(key)))
    whole = F.floor(col(copies))
    extra = uniform(seed, col(id_col)) < col(copies) - whole
    return joined.withColumn(copies, (whole + F.when(extra, 1).otherwise(0)).cast("int")).select(
        *[col(c) for c in docs.columns], col(size), col(source_size), col(target), col(copies)
    )


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mixing_plan` says."""
    plan = mixing_plan(docs, **options)
    (turn,) = fresh(plan, "_turn")
    repeated = plan.withColumn(turn, F.explode(F.array_repeat(F.lit(1), col(plan.columns[-1]))))
    return repeated.select(*[col(c) for c in docs.columns])
