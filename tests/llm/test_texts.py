"""Packing, toxicity, HTML, language model, near and suffix dedup against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from roleatlas.llm import html_extract, near_dedup, packing, suffix_dedup, toxicity
from roleatlas.llm.catalog import word_bpe
from roleatlas.llm.suffix_runs import merge_runs, pack_run, unpack_run

TEXT = "doc_id long, text string"
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "b" * 30_000), (6, "a"), (6, "a"), (None, "a"), (7, "é\x00ß ﬀ İ")]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "clash", 1) for i, t in EDGES]
    return spark.createDataFrame(rows, TEXT + ", score string, `x.y` int").repartition(2)


# Packing

def whole_ids(text):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(word_bpe())
    return encoder.encode(text or "", add_special_tokens=False).ids + [0]


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and 0 < length <= capacity
            at += length
        assert at <= capacity
    return len(bins)


def test_pack_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = packing.pack_documents(docs, word_bpe(), with_ids=True).collect()
    total = sum(r["length"] for r in rows)
    assert check_packing(rows, 2048) == -(-total // 2048)
    pieces = defaultdict(list)
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], bytes(r["ids"])))
    for doc in docs.collect():
        parts = sorted(pieces[doc["doc_id"]])
        assert b"".join(p for *_, p in parts) == np.array(whole_ids(doc["text"]), "<u4").tobytes()
        assert [k for k, *_ in parts] == list(range(len(parts))) and all(len(p) == 8192 for *_, p in parts[:-1])
        assert [s for _, s, _ in parts] == [2048 * k for k in range(len(parts))]


def test_pack_edges(spark, edges):
    rows = packing.pack_documents(edges, word_bpe(), 64).collect()
    check_packing(rows, 64)
    lengths = Counter()
    for r in rows:
        lengths[r["doc_id"]] += r["length"]
    want = Counter()
    for i, t in EDGES:
        want[i] += len(whole_ids(t))
    assert lengths == want
    assert packing.pack_documents(edges.limit(0), word_bpe()).count() == 0


def test_two_fit_uses_all_pieces():
    rng = np.random.default_rng(3)
    for _ in range(20):
        counts = np.zeros(101, np.int64)
        np.add.at(counts, rng.integers(1, 101, rng.integers(1, 300)), 1)
        patterns = packing.two_fit_patterns(counts)
        used = sum(n * np.bincount(b, minlength=101) for n, b in patterns)
        assert (used == counts).all() and all(sum(b) <= 100 for _, b in patterns)
    # 9 and 1 go in first; 6 and 4 take the place of the 1 only where they fit.
    assert packing.two_fit_patterns(np.bincount([60, 25, 20, 15], minlength=101))[0][1] == [60, 25, 15]


# Toxicity

def toxic_tables(spark, n=1200):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        if bad:
            text += rng.sample(["zorgish", "zorgal", "vileword", "meanword"], 2)
            rng.shuffle(text)
        rows.append((i, " ".join(text), "en"))
        labels.append((i, int(bad)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels),
    )


def test_toxicity_held_out(spark):
    docs, labels, truth = toxic_tables(spark)
    rows = toxicity.toxicity_scores(docs, labels).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    hits = [r for r in held if r["score"] >= toxicity.THRESHOLD]
    toxic = [r for r in held if truth[r["doc_id"]]]
    good = sum(truth[r["doc_id"]] for r in hits)
    assert good >= 0.9 * len(toxic) and good >= 0.95 * len(hits)
    # Labels of held-out rows and other columns change nothing.
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    other = labels.withColumn("toxic", F.when(held_out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.toxicity_scores(docs.withColumn("lang", F.lit("xx")), other).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {r["doc_id"]: r["score"] for r in rows}


def test_toxicity_edges(spark, edges):
    _, labels, _ = toxic_tables(spark, 30)
    scored = toxicity.toxicity_scores(edges, labels)
    assert scored.columns == edges.columns + ["_score"]
    assert all(0 <= r["_score"] <= 1 for r in scored.collect()) and scored.count() == len(EDGES)
    assert all(r["_score"] == 0 for r in toxicity.toxicity_scores(edges, labels.limit(0)).collect())
    assert toxicity.toxicity_scores(edges.limit(0), labels).count() == 0


# HTML

def test_html_parts():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><a href=/>Home</a></header><nav><ul><li>One<li>Two</ul></nav><div id="cookie-notice">We use cookies.</div>
    <main><h1>A &amp; B</h1><p>First,   long <b>paragraph</b> of text&#46; And more of it, really.<br>Next line
    <p>Second&nbsp;one: <i>it</i> goes on &rarr; here&hellip;<ul><li>short</li></ul><blockquote>quote &#146;x&#146;</blockquote>
    <form>name <input></form><aside>see also</aside><div class="comments"><p>I disagree, a lot, with it.</p></div></main>
    <footer>(c) me</footer><script>var a = "<p>no</p>";</script></body></html>"""
    assert html_extract.main_text(page).split("\n") == [
        "A & B", "First, long paragraph of text. And more of it, really. Next line",
        "Second one: it goes on → here…", "short", "quote ’x’",
    ]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("<nav>menu</nav>", ""),
    ("<body><script>var x", ""), ("<article><p>Some text, more text.</article>tail", "Some text, more text."), ("a < b <p>c", "a < b\nc"), ("<!-- <p>x</p>", ""),
    ("<div class=ad>buy</div><div><p>Good, long text here.</p></div>", "Good, long text here."),
])
def test_html_edges(page, text):
    assert html_extract.main_text(page) == text


def test_html_table(spark):
    rows = [(1, "<p>x", "t"), (1, "<p>x", "t"), (2, None, None), (3, "<p>" + "word, " * 50_000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_extract.extract_text(pages)
    assert got.columns == ["page_id", "html", "text", "_text"]
    assert sorted(len(r["_text"]) for r in got.collect()) == [0, 1, 1, 299_999]
    assert html_extract.extract_text(pages.limit(0)).count() == 0


# Near-duplicates

def brute_classes(rows, idf):
    import pyarrow as pa

    reps = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        reps.setdefault(t or "", i)
    texts = list(reps)
    shingle, weight, begins = near_dedup.weighted_shingles(pa.array(texts, pa.string()), idf)
    items = [dict(zip(shingle[a:b].tolist(), weight[a:b])) for a, b in zip(begins[:-1], begins[1:])]
    root = {reps[t]: reps[t] for t in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(items):
        for j in range(i):
            b = items[j]
            common = sum(min(w, b[k]) for k, w in a.items() if k in b)
            if common and common / (sum(a.values()) + sum(b.values()) - common) >= 0.8:
                x, y = find(reps[texts[i]]), find(reps[texts[j]])
                root[max(x, y)] = min(x, y)
    return {i: find(reps[t or ""]) for i, t in rows if i is not None}


def test_near_groups(spark, sf, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rng = random.Random(4)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    words = rows[0][1].split()[:120] or ["a"]
    words += [f"w{k}" for k in range(120 - len(words))]
    for i in range(60):
        copy = list(words)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        rows.append((10_000 + i, " ".join(copy)))
    table = spark.createDataFrame(rows, TEXT).repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_groups(table).collect()}
    want = brute_classes(rows, near_dedup.word_idf(table))
    assert set(got) == set(want)
    # A band can miss a pair near the threshold; classes are never wider than they should be.
    missed = sum(got[i] != want[i] for i in want)
    assert missed <= 0.01 * len(want) and all(want[got[i]] == want[i] for i in got)


def test_near_edges(spark, edges):
    rows = near_dedup.near_groups(edges).collect()
    assert len(rows) == len(EDGES)
    by_id = {r["doc_id"]: r["class_id"] for r in rows}
    assert by_id[1] == by_id[2] == 1 and by_id[3] == 3 and by_id[6] == by_id[None] == 4
    kept = near_dedup.drop_near_copies(edges)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 3, 4, 5, 7]
    assert near_dedup.near_groups(edges.limit(0)).count() == 0


def test_samples_estimate_similarity():
    import pyarrow as pa

    rng = random.Random(0)
    idf = np.ones(near_dedup.IDF_BUCKETS, np.float32) + np.random.default_rng(0).random(near_dedup.IDF_BUCKETS, np.float32)
    errors = []
    for k in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(150)]
        other = base[:150 - 2 * k] + [f"v{rng.randrange(5000)}" for _ in range(2 * k)]
        s, w, b = near_dedup.weighted_shingles(pa.array([" ".join(base), " ".join(other)]), idf)
        true = near_dedup.similar((s[b[0]:b[1]], w[b[0]:b[1]]), s[b[1]:], w[b[1]:], np.zeros(1, np.int64))[0]
        drawn = near_dedup.samples(s, w, b[:-1])
        errors.append((drawn[0] == drawn[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.03


# Suffix dedup

def brute_cut(rows, length):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            if data[s:s + length] in seen:
                gone[s:s + length] = [True] * length
            seen.add(data[s:s + length])
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        left = bytes(b for b, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


def cut_rows(df):
    return {
        r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]),
                      hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()
    }


@pytest.mark.parametrize("length, hot", [(100, 10_000), (100, 2), (24, 3)])
def test_suffix_brute(spark, length, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_SUFFIXES", 50)
    monkeypatch.setattr(suffix_dedup, "RUN_BYTES", 5000)
    rng = random.Random(1)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(50)]
    pick = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, rows = [pick(30) for _ in range(5)], []
    for i in range(120):
        parts = [pick(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared)[rng.choice([0, 0, 17]):], pick(rng.randint(0, 9))]
        rows.append((3 * i - 20, " ".join(parts)))
    rows += [(1000, "a" * 500), (1001, "ab" * 200), (1002, None), (1003, ""), (5, "x" * (length - 1)), (1 << 30, "a" * 120)]
    docs = spark.createDataFrame(rows, TEXT).repartition(5)
    assert cut_rows(suffix_dedup.remove_repeats(docs, length, hot=hot)) == brute_cut(rows, length)


def test_suffix_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert cut_rows(suffix_dedup.remove_repeats(docs)) == brute_cut(rows, 100)


def test_suffix_edges(spark, edges):
    rows = suffix_dedup.remove_repeats(edges).collect()
    assert len(rows) == len(EDGES) and not any(r["spans"] for r in rows if r["doc_id"] != 5)
    twice = edges.unionAll(edges)
    assert suffix_dedup.remove_repeats(twice).count() == 2 * len(EDGES)
    far = spark.createDataFrame([(-(1 << 62), "q" * 150), (1 << 62, "q" * 150)], TEXT)
    got = {r["doc_id"]: len(bytes(r["kept"])) for r in suffix_dedup.remove_repeats(far).collect()}
    assert got == {-(1 << 62): 1, 1 << 62: 0}
    assert suffix_dedup.remove_repeats(edges.limit(0)).count() == 0


def test_merge_of_runs():
    rng = random.Random(9)
    for n in (1, 2, 3, 5, 8):
        runs, everything = [], []
        for _ in range(n):
            some = sorted(bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 40)))
            k = len(some)
            blob = pack_run(some, [b"l%d" % i for i in range(k)], np.arange(k), np.zeros(k, np.int64))
            runs.append(unpack_run(blob))
            assert runs[-1].suffix == some and runs[-1].left == [b"l%d" % i for i in range(k)]
            everything += some
        merged = [(runs[r].suffix[i], shared) for r, i, shared in merge_runs(runs)]
        assert [s for s, _ in merged] == sorted(everything)
        for (a, _), (b, shared) in zip(merged, merged[1:]):
            assert shared == len(next(iter([a[:k] for k in range(min(len(a), len(b)), -1, -1) if a[:k] == b[:k]])))


# Pipeline

def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], sf).cache())
        if name != "pack_sequences":
            assert seen[-1].schema == docs.schema or seen[-1].columns == docs.columns
    toxic = {r["doc_id"] for r in toxicity.toxicity_scores(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect() if r["score"] >= 0.7}
    ids = [Counter(r["doc_id"] for r in s.select("doc_id").collect()) for s in seen[:5]]
    assert set(ids[1]) == set(ids[0]) - toxic
    texts = {r["doc_id"]: " ".join((r["text"] or "").split()) for r in docs.collect()}
    assert len({texts[i] for i in ids[2]}) == len(ids[2]) and {texts[i] for i in ids[2]} == {texts[i] for i in ids[1]}
    assert set(ids[3]) <= set(ids[2]) and max(ids[4].values()) <= 3
    rows = seen[5].collect()
    check_packing(rows, 2048)
    pieces = Counter(r["doc_id"] for r in rows if r["piece"] == 0)
    assert pieces == ids[4]
    assert "pipeline" in __spark_entry__.queries()
