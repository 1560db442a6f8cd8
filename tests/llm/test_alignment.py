"""Token links against all pairs of byte spans."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roleatlas.llm import alignment as A
from roleatlas.llm.catalog import registry

PATH_A, PATH_B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def encoders():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PATH_B)


def spans(ids, sizes):
    ends = np.cumsum([sizes[i] for i in ids]).tolist()
    return list(zip([0, *ends], ends))


def plain(encoders, text):
    """Ids, links and groups of a text, each by its definition."""
    a, b = encoders
    if not text:
        return [], [], [], []
    ids_a, ids_b = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
    letters = A.byte_letters()
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in ids_b
    ]
    if not b"".join(bytes_a) == b"".join(bytes_b) == f" {text}".encode():
        return [], [], [], []
    of_a, of_b = ([(s, e) for s, e in spans(range(len(x)), [len(y) for y in x])] for x in (bytes_a, bytes_b))
    links = [(x, y) for x, (s, e) in enumerate(of_a) for y, (u, v) in enumerate(of_b) if max(s, u) < min(e, v)]
    groups, begin = [], 0
    for cut in sorted({e for _, e in of_a} & {e for _, e in of_b}):
        groups.append("|".join(
            ",".join(str(i) for i, (s, e) in zip(ids, of) if begin <= s and e <= cut)
            for ids, of in ((ids_a, of_a), (ids_b, of_b))
        ))
        begin = cut
    return ids_a, ids_b, [(ids_a[x], ids_b[y]) for x, y in links], groups


def expected(encoders, texts):
    found = [plain(encoders, t) for t in texts]
    counts = Counter(link for f in found for link in f[2])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
         sum(counts[x] for x in links), ";".join(groups))
        for a, b, links, groups in found
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def digest(groups):
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def test_query(spark, sf, encoders):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    some = [r for r in docs if len(r["text"] or "") < 3000]
    rows = spark.createDataFrame(some, "doc_id long, text string")
    got = {r["doc_id"]: r for r in A.align_tokenizers(rows, PATH_A, PATH_B).collect()}
    for row, (*counts, groups) in zip(some, expected(encoders, [r["text"] for r in some])):
        mine = got[row["doc_id"]]
        assert [mine[c] for c in COLUMNS] == counts and mine["digest"] == digest(groups)
    whole = registry.queries["op11_token_alignment"](spark, sf)
    assert whole.columns == ["doc_id", *COLUMNS[:4], "groups_sha256", *COLUMNS[4:]] and whole.count() == len(docs)


EDGES = [
    None, "", "a", " ", "  ", "\n\n x", "a▁b", "<|endoftext|> <s> <unk> <0x41>", "日本語 テキスト", "🙂🙂 ok", "é̀",
    "\u0000", "x" * 5000, " " * 5000, "word " * 2000, "trail \t", "a  b   c", "ß ü\u0085\u001cz", "same", "same",
]


@pytest.mark.parametrize("frequent", [A.FREQUENT, 40])
def test_edges(spark, encoders, frequent):
    """Also with few frequent pairs, so that the others are joined."""
    rows = [(k if k % 7 else None, t, k, "x") for k, t in enumerate(EDGES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Row long, digest string").repartition(3)
    found = A.align_tokenizers(docs, PATH_A, PATH_B, with_groups=True, frequent=frequent).collect()
    got = sorted([tuple(r[c] for c in COLUMNS) + (r["groups"],) for r in found])
    assert got == sorted(expected(encoders, EDGES))
    assert all(r["digest"] == digest(r["groups"]) for r in found)
    ids = sorted((r["doc_id"] is None, r["doc_id"]) for r in found if r["doc_id"] is not None)
    assert [i for _, i in ids] == [k for k in range(len(EDGES)) if k % 7]


def test_empty(spark):
    assert not A.align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), PATH_A, PATH_B).collect()


cuts = st.lists(st.integers(1, 60), max_size=40)


@given(cuts, cuts, st.lists(st.integers(1, 60), max_size=40))
@settings(max_examples=300, deadline=None)
def test_runs(only_a, only_b, shared):
    """Marks and links of any two ways to cut 61 bytes."""
    ends = [np.array(sorted({*x, *shared, 61})) for x in (only_a, only_b)]
    mark_a, mark_b, link_a, link_b = A.align(*ends)
    ones = list(zip(np.flatnonzero(mark_a == 0).tolist(), np.flatnonzero(mark_b == 0).tolist()))
    starts = [np.append(0, e[:-1]) for e in ends]
    wanted = [
        (x, y) for x in range(len(ends[0])) for y in range(len(ends[1]))
        if max(starts[0][x], starts[1][y]) < min(ends[0][x], ends[1][y])
    ]
    assert sorted(ones + list(zip(link_a, link_b))) == wanted
    common = np.intersect1d(*ends)
    assert ends[0][mark_a < 2].tolist() == ends[1][mark_b < 2].tolist() == common.tolist()


def test_fast_and_slow_agree(encoders):
    """The quick path on each of its characters, alone and between others."""
    own = A.side(PATH_A).tokenizer
    for code in [*range(0x250), *range(0x2010, 0x2028)]:
        for text in (chr(code), f"a{chr(code)}1 {chr(code)}", f"'{chr(code)}{chr(code)}\n"):
            assert own.one(f" {text}").tolist() == encoders[0].encode(f" {text}", add_special_tokens=False).ids


PARTS = st.lists(st.sampled_from(["a", "Word", " ", "  ", "\n", "\t", "é", "▁", "1", "'s", ".", "\u0085", "ﬁ", "日"]), max_size=25)


@given(PARTS)
@settings(max_examples=400, deadline=None)
def test_parts_are_tokenized_alike(encoders, parts):
    """Any mixture of words and white space, in parts and as a whole."""
    text = "".join(parts)
    ids_a, ids_b, _, _ = plain(encoders, text)
    if ids_a:
        assert A.side(PATH_A).encode(*A.split([text]))[0].tolist() == ids_a
        assert A.side(PATH_B).encode(*A.split([text]))[0].tolist() == ids_b
    else:
        assert not all(len(A.side(p).encode(*A.split([text]))[0]) for p in (PATH_A, PATH_B))


def test_pairs_survive_packing():
    key = np.array([3, 1 << 33, (1 << 33) + 7, 5 << 40])
    times = np.array([1, 300, 70_000, 2])
    assert [x.tolist() for x in A.unpack_pairs(A.pack_pairs(key, times))] == [key.tolist(), times.tolist()]
    assert [len(x) for x in A.unpack_pairs(A.pack_pairs(key[:0], times[:0]))] == [0, 0]


def test_slices_of_many_texts():
    a, b = A.side(PATH_A), A.side(PATH_B)
    texts = ["one two", "", "thrée", "one two"]
    assert [g for t in texts for g in A.Aligned(a, b, [t]).groups()] == A.Aligned(a, b, texts).groups()
    assert pa.array(texts).null_count == 0
