"""The n-gram join against all pairs of exact shingle sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from roleatlas.llm import ngram_join as J
from roleatlas.llm.catalog import registry


def sets_of(texts):
    out = []
    for text in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        grams = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        out.append(set(grams) if grams else {tuple(words)} if words else set())
    return out


def brute(rows):
    """``id: (n_shingles, component)`` by comparing all pairs; rows of one id are one document."""
    sets = sets_of([t for _, t in rows])
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (a, _) in enumerate(rows):
        for y, (b, _) in enumerate(rows[:x]):
            both, any_ = len(sets[x] & sets[y]), len(sets[x] | sets[y])
            if both and 100 * both >= 90 * any_:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((i, len(s), find(i)) for (i, _), s in zip(rows, sets))


def run(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted(tuple(r) for r in J.ngram_components(docs).collect())


def edited(words, share, rng):
    return " ".join(rng.choice(["new", "other"]) + str(rng.random()) if rng.random() < share else w for w in words)


def corpus(n, seed):
    """Texts around a few originals, at and about the threshold, and some of the same frequent words."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n // 20):
        words = [f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(rng.randint(3, 150))]
        texts += [" ".join(words)] * 2
        texts += [edited(words, rng.choice([0.004, 0.01, 0.02, 0.04]), rng) for _ in range(12)]
        texts += [" ".join(words[:-k]) for k in range(1, 4)]
        texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(3)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_all_links(spark, seed):
    rows = corpus(400, seed)
    assert run(spark, rows) == brute(rows)


def test_many_members_of_a_key(spark, monkeypatch):
    """Bands and blocks of a group decide the same pairs as one cell."""
    rows = corpus(200, 3)
    rng = random.Random(4)
    words = [f"v{k}" for k in range(60)]
    rows += [(1000 + k, edited(words, 0.03, rng)) for k in range(90)]
    wanted = brute(rows)
    monkeypatch.setattr(J, "BLOCK", 7)
    assert run(spark, rows) == wanted


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in registry.queries["op12_ngram_join"](spark, sf).collect())
    assert got == brute(docs)


def test_edges(spark):
    long = " ".join(f"q{k}" for k in range(40_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "ONE"), (6, "one two"), (7, "two one"), (8, "one two three"),
        (9, long), (10, long + " end"), (11, "É a b"), (12, "é a b"), (13, "x" * 100_000), (13, "one"), (14, "a\x0bb\x0cc d"),
        (15, "A b\rC\nD"),
    ]
    docs = spark.createDataFrame([(*r, "n", 0) for r in rows], "doc_id long, text string, N string, copy_of int")
    got = sorted(tuple(r) for r in J.ngram_components(docs).collect())
    assert got == brute(rows)
    unknown = spark.createDataFrame([(None, "one"), (7, "ONE"), (None, "alone")], "doc_id long, text string")
    assert sorted(map(str, J.ngram_components(unknown).collect())) == sorted([
        "Row(doc_id=None, n_shingles=1, component_id=7)", "Row(doc_id=7, n_shingles=1, component_id=7)",
        "Row(doc_id=None, n_shingles=1, component_id=None)",
    ])
    assert not run(spark, [])


@pytest.mark.parametrize("groups", [16, 64])
def test_tree_loses_nothing(groups):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 200, 700)
    vectors = np.array([np.bincount(rng.integers(0, groups, s), minlength=groups) for s in sizes], np.int32)
    tree = J.CountTree(vectors, sizes)
    for i in range(0, 700, 13):
        most = np.minimum(vectors, vectors[i]).sum(axis=1)
        wanted = np.flatnonzero(100 * most >= 90 * (sizes + sizes[i] - most))
        assert sorted(tree.candidates(vectors[i], sizes[i])) == wanted.tolist()


def test_vectors_of_other_sizes():
    """A vector of more groups adds up to that of fewer, and bounds what sets share."""
    texts = [" ".join(f"x{k % m}" for k in range(n)) for n, m in ((900, 700), (880, 690), (60, 50), (4000, 3000))]
    shingle, begins = J.shingle_sets(pa.array(texts))
    groups = J.groups_for(np.diff(begins))
    assert len(set(groups.tolist())) == 3
    few = int(groups.min())
    rows = J.alike(J.count_vectors(shingle, begins, groups), few)
    assert rows.sum(axis=1).tolist() == np.diff(begins).tolist()
    assert rows.tolist() == J.alike(J.count_vectors(shingle, begins, np.full(4, few)), few).tolist()
    sets = [set(shingle[s:e].tolist()) for s, e in zip(begins, begins[1:])]
    for x in range(4):
        for y in range(4):
            assert len(sets[x] & sets[y]) <= np.minimum(rows[x], rows[y]).sum()


def test_prefixes_meet():
    """Linked sets share a key of their prefixes, whatever the order of shingles."""
    rng = random.Random(6)
    texts = [t for _, t in corpus(200, 6)]
    sets = sets_of(texts)
    shingle, begins = J.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == np.diff(begins).tolist()
    common = np.array([rng.randint(0, 5) for _ in range(J.BUCKETS)])
    keys, ends = J.prefixes(shingle, begins, common)
    heads = [set(keys[s:e].tolist()) for s, e in zip(ends, ends[1:])]
    for x, a in enumerate(sets):
        for y, b in enumerate(sets[:x]):
            if a and 100 * len(a & b) >= 90 * len(a | b):
                assert heads[x] & heads[y]
