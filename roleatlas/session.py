"""Session settings, shared scratch folder, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app: str = "roleatlas", **conf: str) -> SparkSession:
    """A session with the settings the engine relies on; cluster values win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            if configured is None:
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        elif configured is None:
            configured = tempfile.mkdtemp(prefix="roleatlas-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table, wherever it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from that table.

    This cuts the lineage, so a lost executor costs a re-read and not a rerun of
    what came before; unlike an RDD checkpoint, the table is read by column.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input too small to fill them by its file splits.

    A table of a few row groups is read by as few tasks, whatever the cluster.
    One that could fill every core with a full split is left as it is, so nothing
    large is ever shuffled here.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if read_size(df) < cores * split else df


def read_size(df: DataFrame) -> int:
    """Bytes of the rows by the optimizer's estimate, which starts from the sizes of files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def byte_size(df: DataFrame) -> Column:
    """Rough width of a row in bytes, as an expression."""
    total = F.lit(16 * max(len(df.columns), 1)).cast("long")
    for field in df.schema:
        as_text = F.col(f"`{field.name}`").cast("string")
        total = total + F.coalesce(F.octet_length(as_text), F.lit(0))
    return total


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a side before it is broadcast."""
    size = df.agg(F.sum(byte_size(df)).alias("bytes")).first()["bytes"]
    return (size or 0) <= limit


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left",
    limit: int = BROADCAST_BYTES, salts: int = 64,
) -> DataFrame:
    """Join rows to a lookup that has one row per key, whatever either's size.

    A measured small lookup is broadcast.  A larger one is joined by key, where Spark
    splits what is skewed; only keys that are measured to hold a large share of
    ``df`` are salted, and only their lookup rows are repeated.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if fits_broadcast(lookup, limit):
        return df.join(F.broadcast(lookup), on, how)
    hot = hot_keys(df, on, salts)
    return salted_join(df, lookup, on, how, salts, hot) if hot else df.join(lookup, on, how)


def sparse_join(df: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Left join by a whole number for which only rows that have a lookup row are shuffled.

    The keys of the lookup are known by one bit each of 64-bit words; where these are too
    many for a broadcast, all rows are shuffled.
    """
    lookup = materialize(lookup)
    word = F.shiftright(on, 6).alias("_word")
    bits = F.bit_or(F.expr(f"shiftleft(1L, int(`{on}` & 63))")).alias("_bits")
    words = materialize(lookup.groupBy(word).agg(bits))
    if not fits_broadcast(words):
        return df.join(lookup, on, "left")
    marked = df.withColumn("_word", word).join(F.broadcast(words), "_word", "left").withColumn(
        "_has", F.coalesce(F.expr(f"shiftrightunsigned(_bits, int(`{on}` & 63)) & 1L"), F.lit(0)) == 1
    )
    there = marked.filter("_has").select(*df.columns).join(lookup.hint("merge"), on, "left")
    rest = marked.filter("NOT _has").select(*df.columns)
    return there.unionByName(rest, allowMissingColumns=True)


def hot_keys(df: DataFrame, on: list[str], parts: int) -> list[Row]:
    """Keys that hold more than one in ``parts`` rows: fewer than ``parts`` of them."""
    counted = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    first = counted.orderBy(F.col("_n").desc()).limit(parts).collect()
    total = counted.agg(F.sum("_n")).first()[0] if first else 0
    return [r for r in first if r["_n"] * parts > total and None not in r]


def salted_join(
    df: DataFrame, lookup: DataFrame, on: list[str], how: str, salts: int, hot: list[Row]
) -> DataFrame:
    """Spread the rows of ``hot`` keys, and only these, over ``salts`` copies of the lookup's row.

    The salt is a hash of the row, the same on a retry.
    """
    key = F.struct(*on)
    is_hot = key.isin([F.struct(*[F.lit(r[c]) for c in on]) for r in hot])
    row = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")
    last = F.when(is_hot, salts - 1).otherwise(0)
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    salted = df.withColumn("_salt", F.when(is_hot, row).otherwise(0))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
