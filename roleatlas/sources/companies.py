"""Company list, board routing and the outcome of each fetch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.regex import text
from ..schemas import COMPANIES


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """A1: the JSON list of companies; a missing file gives an empty table."""
    try:
        return spark.read.schema(COMPANIES).json(path, multiLine=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMPANIES)


def route_boards(companies: DataFrame) -> DataFrame:
    """One board per company, the first slug set in the fixed order."""
    choice = F.coalesce(*[
        F.when(
            text(F.col(f"{kind}_slug")) != "",
            F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}_slug").alias("slug")),
        )
        for kind in fv.BOARD_ORDER
    ])
    routed = companies.withColumn("board", choice).filter("board IS NOT NULL")
    return routed.select(F.col("name").alias("company"), "board.kind", "board.slug")


def partial_flag(total):
    """The board serves more postings than its paging reaches."""
    return F.coalesce(total > fv.WORKDAY_MAX_TOTAL, F.lit(False))


def classify_fetch(fetch_log: DataFrame, *keep: str) -> DataFrame:
    """What each company's fetch means for its stored listings; columns to ``keep`` stay.

    An HTTP failure other than 404 serves no jobs and so counts as empty; only a
    fetch that left no outcome at all is an error.
    """
    served = F.coalesce(F.col("n_jobs"), F.lit(0)) > 0
    status = (
        F.when(F.coalesce(F.col("timed_out"), F.lit(False)), "timeout")
        .when(F.col("http_status") == 404, "stale_404")
        .when(F.col("http_status").isNull(), "error")
        .when((F.col("http_status") < 400) & served, "ok")
        .otherwise("empty")
    )
    return fetch_log.select(
        "company", status.alias("status"), partial_flag(F.col("total")).alias("partial"), *keep
    )
