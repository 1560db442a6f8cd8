"""Embed the active listings that have no vector yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fv
from ..functions.embedding import Embedder, embed
from ..functions.text import role_text, text_long_enough
from ..operators.vector_table import live_vectors, unembedded
from ..session import materialize


def pending_texts(listings: DataFrame, vectors: DataFrame, limit: int | None = None) -> DataFrame:
    """``url_hash, text`` of what has to be embedded."""
    pending = unembedded(listings, vectors, limit)
    texts = pending.select(
        "url_hash", role_text(F.col("title"), F.col("description_raw")).alias("text")
    )
    return texts.filter(text_long_enough(F.col("text")))


def encode_new(
    listings: DataFrame, vectors: DataFrame, embedder: Embedder | None = None,
    batch: int = fv.EMBED_BATCH, limit: int | None = None, compact: bool = True,
) -> DataFrame:
    """The next version of the vectors table.

    What is pending has no vector yet, so new vectors are appended; stored ones are
    neither compared nor moved.  They are written out first, so that losing an
    executor afterwards does not call the embedder again.  ``compact`` also drops the
    vectors of inactive listings (D3), which reads the keys of all; leave it to a
    run of its own if the table is large.
    """
    new = materialize(embed(pending_texts(listings, vectors, limit), embedder, batch))
    appended = vectors.select("url_hash", "role_vec").unionByName(new.select("url_hash", "role_vec"))
    return live_vectors(appended, listings) if compact else appended


CHUNK_ROWS = 1_000_000


def finished_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """What chunks that came to their end have left in ``folder``."""
    try:
        spark.read.format("parquet").schema(schemas.VECTORS).load(folder).schema
        return spark.read.schema(schemas.VECTORS).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.VECTORS)


def encode_in_chunks(
    listings: DataFrame, vectors: DataFrame, folder: str, embedder: Embedder | None = None,
    batch: int = fv.EMBED_BATCH, limit: int | None = None, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """J6, resumable: pending texts are embedded chunk by chunk, each kept as soon as it is done.

    A chunk is a hash share of the pending keys, about ``chunk_rows`` of them, and one job
    that adds files to ``folder`` when it commits.  If the embedder fails, chunks before
    stay, and another call with the same folder embeds only what is still missing.
    Returns the vectors with those of the folder; orphans can be dropped afterwards.
    """
    spark = listings.sparkSession
    own = vectors.select("url_hash", "role_vec")
    held = own.unionByName(finished_vectors(spark, folder))
    pending = materialize(pending_texts(listings, held, limit))
    chunks = -(-pending.count() // chunk_rows)
    for chunk in range(chunks):
        part = pending.filter(F.pmod(F.xxhash64("url_hash"), F.lit(chunks)) == chunk)
        embed(part, embedder, batch).select("url_hash", "role_vec").write.mode("append").parquet(folder)
    return own.unionByName(finished_vectors(spark, folder))
