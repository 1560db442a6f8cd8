"""What suffix dedup moves: copies travel as signatures, texts only where contexts differ."""

import random

from pyspark.sql import functions as F

from roleatlas import session
from roleatlas.llm import suffix_dedup


def letters(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("abcdefgh ") for _ in range(n))


def test_copies_do_not_move_as_text(spark, monkeypatch):
    rng = random.Random(5)
    passage, moved = letters(rng, 3000), []
    rows = [(i, f"{letters(rng, 150)}{i}:{passage}:{i}{letters(rng, 150)}") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(24, "doc_id").cache()

    def spy(keyed, *args, real=suffix_dedup.mapped_rows, **more):
        made = real(keyed, *args, **more)
        if "run" in made.columns:
            moved.append(made.agg(F.sum(F.octet_length("run"))).first()[0] or 0)
        return made

    monkeypatch.setattr(suffix_dedup, "mapped_rows", spy)
    got = {r["doc_id"]: r["n_bytes"] - len(r["kept"]) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got[0] == 0 and all(got[i] == len(passage) + 2 for i in range(1, 24) if i < 10)
    assert sum(moved) < 24 * len(passage) / 4


def test_only_rows_that_are_found_are_shuffled(spark):
    rows = spark.range(-300, 300, 1, 4).select(F.col("id").alias("key"), F.concat(F.lit("t"), "id").alias("text"))
    lookup = spark.createDataFrame([(k, [k, 7]) for k in (-300, -129, -64, -1, 0, 63, 64, 299, 5000)], "key long, found array<long>")
    joined = session.sparse_join(rows, lookup, "key")
    got = {r["key"]: (r["text"], r["found"]) for r in joined.collect()}
    assert joined.columns == ["key", "text", "found"] and len(got) == joined.count() == 600
    assert {k: v[1] for k, v in got.items() if v[1]} == {k: [k, 7] for k in (-300, -129, -64, -1, 0, 63, 64, 299)}
    assert all(v[0] == f"t{k}" for k, v in got.items())
    # Few rows only, whatever Spark would choose by size.
    assert spark.range(3).selectExpr("id as key").transform(lambda d: session.sparse_join(d, lookup, "key")).count() == 3
