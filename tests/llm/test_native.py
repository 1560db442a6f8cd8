"""Exact dedup, mixing and line dedup on edge cases; the queries have oracle SQL."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roleatlas.llm import exact_dedup, line_dedup, mixing

DOCS = "doc_id long, text string, source string, keep_id string, `a.b` int"
ROWS = [
    (5, "same  text", "s1", "x", 1), (3, "same\ttext", "s2", "y", 2), (9, "same text", None, None, None),
    (4, None, "s1", "z", 3), (2, "", "s1", "z", 3), (7, "other", "s2", "q", 4), (7, "other", "s2", "q", 4),
    (None, "other", "s2", "q", 4), (8, "x" * 50_000, "", "q", None), (None, "only", "s9", "q", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


def groups_of(rows):
    by_text = defaultdict(list)
    for i, text, *_ in rows:
        by_text[" ".join((text or "").split(" ")) if text is None else text.replace("\t", " ").replace("  ", " ")].append(i)
    out = Counter()
    for ids in by_text.values():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            out[(i, keep, len(ids), i == keep)] += 1
    return out


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.lit(b"one"), lambda t: F.length(t).cast("string").cast("binary")])
def test_exact_groups(docs, digest):
    found = exact_dedup.exact_groups(docs, digest=digest)
    got = Counter((r[0], r[1], r[2], r[3]) for r in found.collect())
    assert got == groups_of(ROWS)


def test_exact_empty_and_kept(spark, docs):
    assert exact_dedup.exact_groups(docs.limit(0)).collect() == []
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 2, 3, 7, 7, 8]


def level(sizes, weights):
    """Targets by resharing until none is above three times its size."""
    stopped, total = set(), sum(sizes)
    while True:
        left = total - sum(3 * sizes[i] for i in stopped)
        open_ = sum(w for i, w in enumerate(weights) if i not in stopped)
        share = [3 * s if i in stopped else left * weights[i] / open_ for i, s in enumerate(sizes)]
        more = {i for i, s in enumerate(sizes) if share[i] >= 3 * s and i not in stopped}
        if not more or len(stopped | more) == len(sizes):
            return share
        stopped |= more


@pytest.mark.parametrize("sizes", [[100, 1, 50], [10, 10, 10, 10], [1000, 1, 1, 1, 1], [0, 5, 7]])
def test_targets(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    weights = [1 + i % 3 for i in range(len(sizes))]
    sources = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(mixing.cyclic_weights(sources)).collect()}
    for name, target in zip(names, level(sizes, weights)):
        assert got[name] == pytest.approx(target)
    assert sum(got.values()) == pytest.approx(sum(sizes))


def test_mix(spark, docs):
    plan = mixing.mixing_plan(docs).collect()
    assert len(plan) == len(ROWS)
    assert mixing.mixing_plan(docs).columns == docs.columns + ["size", "source_size", "target", "copies"]
    assert all(0 <= r["copies"] <= 3 for r in plan)
    again = Counter((r["doc_id"], r["text"], r["copies"]) for r in mixing.mixing_plan(docs.repartition(5)).collect())
    assert again == Counter((r["doc_id"], r["text"], r["copies"]) for r in plan)
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in plan)
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    clash = mixing.mixing_plan(docs.withColumn("Size", F.lit(1)))
    assert clash.columns[-4:] == ["_size", "source_size", "target", "copies"]


def test_mix_reaches_targets(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{0 if i % 3 == 0 else i % 7}") for i in range(6000)]
    plan = mixing.mixing_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    sums = plan.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.05 for r in sums)


def test_lines(spark):
    rows = [(i, f"Head line \nown {i}\n\n  Foot\r", f"s{i % 9}") for i in range(18)]
    rows += [(100, "own 3\nHead line", None), (101, None, "s1"), (102, "", None), (103, "Seven\n", "s8")]
    rows += [(200 + i, "Seven", f"t{i}") for i in range(7)] + [(300 + i, "Only six\nrest", f"u{i % 6}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_lines", F.lit(7))
    got = {r["doc_id"]: (r["text"], r["_n_lines"], r["n_removed"]) for r in line_dedup.drop_spread_lines(docs).collect()}
    assert got[0] == ("own 0\n", 4, 2) and got[100] == ("own 3", 2, 1)
    assert got[101] == (None, 0, 0) and got[102] == ("", 1, 0)
    assert got[103] == ("", 2, 1) and got[203] == ("", 1, 1)  # eight sites with s8
    assert got[305] == ("Only six\nrest", 2, 0)
    assert len(got) == len(rows)
    assert line_dedup.drop_spread_lines(docs.limit(0)).count() == 0


def test_lines_margin_changes_nothing(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    results = []
    for margin in (0.25, 1.0):
        monkeypatch.setattr(line_dedup, "MARGIN", margin)
        results.append({tuple(r) for r in line_dedup.spread_lines(docs, "text", "source", 5).collect()})
    assert results[0] == results[1]


def test_native_plans(docs):
    for df in (exact_dedup.exact_groups(docs), mixing.mixing_plan(docs), line_dedup.drop_spread_lines(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
