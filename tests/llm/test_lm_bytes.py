"""The byte language model against a brute force one."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roleatlas.llm import lm_bytes
from roleatlas.llm.catalog import registry

TEXT = "doc_id long, text string"
LOWERED = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def symbols(text):
    return [*(text or "").encode().translate(LOWERED), "end"]


def context(before, k):
    return tuple((["start"] * k + before)[len(before):]) if k else ()


def brute(texts):
    """A function of a text: log10 of its probability, symbol by symbol, under byte PPM of the texts."""
    counts = defaultdict(Counter)
    for text in texts:
        all_ = symbols(text)
        for i, s in enumerate(all_):
            for k in range(lm_bytes.ORDER + 1):
                counts[context(all_[:i], k)][s] += 1

    def probability(before, s):
        p, gone = 1.0, set()
        for k in range(lm_bytes.ORDER, -1, -1):
            left = {x: n for x, n in counts[context(before, k)].items() if x not in gone}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if s in left:
                return p * left[s] / total
            p *= len(left) / total
            gone |= set(left)
        return p / (257 - len(gone))

    return lambda text: sum(np.log10(probability(symbols(text)[:i], s)) for i, s in enumerate(symbols(text)))


@pytest.mark.parametrize("part, frequent, held", [(10**6, 10**6, 10**6), (50, 7, 20)])
def test_bytes_brute(spark, monkeypatch, part, frequent, held):
    monkeypatch.setattr(lm_bytes, "PART_GRAMS", part)
    monkeypatch.setattr(lm_bytes, "FREQUENT_WORDS", frequent)
    monkeypatch.setattr(lm_bytes, "FREQUENT_GRAMS", frequent)
    monkeypatch.setattr(lm_bytes, "HELD_KEYS", held)
    rng = random.Random(2)
    pool = ["".join(rng.choice("abç") for _ in range(rng.randint(1, 9))) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(pool[:30] if i % 4 else pool) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    rows += [(100, None), (101, "ABÇ  zzz\nq"), (104, "abc " * 50), (None, "ab"), (104, "abc"), (105, None), (109, "")]
    training = F.coalesce(F.col("doc_id") % 4 != 0, F.lit(False))
    got = lm_bytes.byte_lm_scores(spark.createDataFrame(rows, TEXT).repartition(3), training).collect()
    learnt = [t for i, t in rows if i is not None and i % 4]
    score, words = brute(learnt), Counter()
    for t in learnt:
        words.update((t or "").encode().translate(LOWERED).split())
    n, v = sum(words.values()) + len(learnt), len(words) + 1
    want = []
    for i, t in rows:
        own = (t or "").encode().translate(LOWERED).split()
        base = sum(np.log10((words[w] + 1) / (n + v + 1)) for w in own) + np.log10((len(learnt) + 1) / (n + v + 1))
        want.append((str(i), len(own) + 1, sum(w in words for w in own) + 1, n, round(base, 6), round(score(t), 6)))
    rounded = sorted((str(r[0]), r[1], r[2], r[3], round(r[4], 6), round(r[5], 6)) for r in got)
    for a, b in zip(rounded, sorted(want), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=2e-5)


def test_query_knows_word_order(spark, tmp_path):
    fluent = "the cat sat on the mat and the dog lay by the door"
    mixed = "mat the by door cat on sat dog the and the lay the"
    # Fold 2 of 7 is held out; both texts are scored, and only the fluent one is learnt.
    rows = [(i, fluent) for i in range(200)] + [(1000 + i, mixed) for i in range(200)]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    spark.createDataFrame(rows, TEXT).filter(held | (F.col("doc_id") < 1000)).write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.queries["op6_lm_score"](spark, str(tmp_path)).filter("held_out").collect()
    first = [r["score"] for r in got if r["doc_id"] < 1000]
    second = [r["score"] for r in got if r["doc_id"] >= 1000]
    assert first and second and min(first) > max(second)


def test_bytes_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "b" * 30_000), (6, "a"), (6, "a"), (None, "a"), (7, "é\x00ß ﬀ İ")]
    docs = spark.createDataFrame(rows, TEXT).repartition(2)
    none = lm_bytes.byte_lm_scores(docs, F.lit(False)).collect()
    assert sorted(round(r["score"], 6) for r in none if r["doc_id"] in (1, 4)) == [
        round(-2 * np.log10(257), 6), round(-np.log10(257), 6)]
    assert len(none) == len(rows)
    assert all(r["score"] < 0 for r in lm_bytes.byte_lm_scores(docs, F.lit(True)).collect())
    assert lm_bytes.byte_lm_scores(docs.limit(0), F.lit(True)).count() == 0
