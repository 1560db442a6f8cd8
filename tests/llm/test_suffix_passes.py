"""Suffix dedup when the texts are read in other splits by each pass."""

import random

import numpy as np
from pyspark.sql import functions as F

from roleatlas.llm import suffix_dedup


def test_passes_may_be_cut_differently(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    twice, often = letters(300), letters(300)
    for i in range(6):
        # Digits bound the passages, so that no neighbour is equal by chance.
        text = letters(200) + (f"{i}{twice}{i}" if i in (1, 4) else "") + letters(50) + f"{i}{often}{i}"
        spark.createDataFrame([(i, text)], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    splits = []

    def other_splits(df, real=suffix_dedup.materialize):
        if splits:
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            spark.conf.set("spark.sql.files.minPartitionNum", "1")
        splits.append(docs.withColumn("x", F.lit(len(splits))).rdd.getNumPartitions())
        return real(df)

    monkeypatch.setattr(suffix_dedup, "materialize", other_splits)
    try:
        for hot in (4, 10_000):
            rows = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, hot=hot).collect()}
            gone = {i: r["n_bytes"] - len(r["kept"]) for i, r in rows.items()}
            assert splits == [6, 1]
            assert gone == {0: 0, 1: 300, 2: 300, 3: 300, 4: 600, 5: 300}
            splits.clear()
            spark.conf.unset("spark.sql.files.openCostInBytes")
            spark.conf.unset("spark.sql.files.minPartitionNum")
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_parts_follow_the_occurrences(spark, monkeypatch):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = [(i, f"{i}:{passage}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12).cache()
    made = []

    def parts(keyed, filters, n, *args, real=suffix_dedup.mapped_rows, **more):
        made.append(n)
        return real(keyed, filters, n, *args, **more)

    monkeypatch.setattr(suffix_dedup, "PART_SUFFIXES", 100)
    monkeypatch.setattr(suffix_dedup, "mapped_rows", parts)
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sum(r["n_bytes"] - len(r["kept"]) for r in got) >= 599 * 300
    data = np.frombuffer(rows[0][1].encode(), np.uint8)
    anchors = len(set(suffix_dedup.anchors(data, np.array([0, len(data)]), 100, 32)[3].tolist()))
    # Nearly every anchor of a text is one of the passage and occurs 600 times.
    assert set(made) == {made[0]} and made[0] >= 600 * (anchors - 2) // 100
