"""Links between the tokens that two tokenizers make of the same text."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import col, kept
from .words import slices

TEXT_BYTES = 1 << 20
FREQUENT = 1 << 20
PARTIAL = 1 << 21
NEAR = 8
# Before a space that follows another character and precedes one that is not white, both
# tokenizers always begin a token.
CUT = re.compile(r"(?<=[^ ]) (?=\S)")
# Short parts between such places, nearly all of them words, are remembered.
SHORT, REMEMBERED, TOGETHER = 64, 300_000, 2000
# Texts of these characters are split alike by all versions of the pattern; runs beyond the
# second bound take the slower encoder, which does not mind them.
PLAIN = re.compile("[\x00-ɏ‐-‧]*")
ODD = re.compile(r"^\s|^$| $|▁")
RUN = re.compile(r"\S{1000}|\s{1000}")


def byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level BPE of the ``tokenizers`` format: ids of space + text."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items()}
        # Ids of such a vocabulary are in the order of its merges, so they serve as ranks.
        self.fast = tiktoken.Encoding(
            "byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.one(f" {text}") for text in texts]

    def one(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and not RUN.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


class Pieces:
    """A sentencepiece model: ids of the text, before which it sets a space itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.bytes = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(n)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.model.encode(texts, out_type=int, num_threads=1)]


class Side:
    """One tokenizer with the bytes of its tokens and their ids in digits."""

    def __init__(self, path: str) -> None:
        self.tokenizer = (Pieces if path.endswith(".model") else ByteLevel)(path)
        self.bytes = self.tokenizer.bytes
        self.known: dict[str, bytes | None] = {}
        self.size = np.array([len(b) for b in self.bytes], np.int32)
        names = [str(i).encode() for i in range(len(self.bytes))]
        self.digits = np.array([len(n) for n in names])
        self.width = int(self.digits.max()) + 1
        self.name = np.frombuffer(b"".join(n.ljust(self.width) for n in names), np.uint8).reshape(-1, self.width)

    def learn(self, parts: list[str]) -> None:
        """Remember the ids of parts, each with a space before it, or that they don't spell it."""
        apart = []
        while parts:
            some, parts = parts[:TOGETHER], parts[TOGETHER:]
            # What may stand between others without a change to its tokens.
            plain = [p for p in some if len(p) <= SHORT and not ODD.search(p)]
            apart += [p for p in some if len(p) > SHORT or ODD.search(p)]
            if not self.learn_together(plain):
                apart += plain
        for part, ids in zip(apart, self.tokenizer.encode(apart)):
            spelt = b"".join([self.bytes[i] for i in ids.tolist()])
            self.known[part] = ids.tobytes() if spelt == b" " + part.encode() else None

    def learn_together(self, parts: list[str]) -> bool:
        """Encode parts in a row, if their tokens spell them."""
        (ids,) = self.tokenizer.encode([" ".join(parts)])
        spelt = b"".join([self.bytes[i] for i in ids.tolist()])
        if spelt != " ".join(["", *parts]).encode():
            return False
        ends = np.cumsum(self.size[ids])
        wanted = np.cumsum([1 + len(p.encode()) for p in parts])
        at = np.searchsorted(ends, wanted)
        if not len(parts) or not np.array_equal(ends[at], wanted):
            return False
        data, begin = ids.astype("<u4").tobytes(), 0
        for part, stop in zip(parts, (4 * at + 4).tolist()):
            self.known[part] = data[begin:stop]
            begin = stop
        return True

    def encode(self, parts: list[list[str]], distinct: set[str]) -> list[np.ndarray]:
        """Ids of each text by its parts; none where their bytes are not a space and the text."""
        fresh = list(distinct - self.known.keys())
        self.learn(fresh)
        known, out = self.known, []
        for of in parts:
            found = [known[p] for p in of]
            out.append(np.frombuffer(b"" if None in found else b"".join(found), "<u4"))
        for part in fresh:
            if len(part) > SHORT:
                del known[part]
        if len(known) > REMEMBERED:
            self.known = {}
        return out


def split(texts: list[str]) -> tuple[list[list[str]], set[str]]:
    """The parts of each text that are tokenized alone, and all of them."""
    parts = [CUT.split(t) if t else [] for t in texts]
    return parts, set().union(*parts)


def side(path: str) -> Side:
    return kept(f"tokenizer {path}", lambda: Side(path))


def align(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """Where the tokens of two sequences end together, by diagonal run skipping.

    ``end_a`` and ``end_b`` are the byte offsets at which tokens end; both run over the
    same bytes.  At a common end, tokens are compared at the present shift between the
    indices: some one by one, then stretches of twice the length each time, then of half
    the length, until the first difference.  A group that is not one to one is walked
    through token by token, which gives the new shift.

    Returns for each token of A, and of B, 0 if it is linked to one token that is
    linked to it alone, 1 if it is the last of a larger group on its side and 2 if it is
    another of one; then the links within larger groups, as two lists of indices.
    """
    n, m = len(end_a), len(end_b)
    bytes_a, bytes_b = end_a.astype(np.int32).tobytes(), end_b.astype(np.int32).tobytes()
    # Beyond their ends the two never agree.
    ends_a, ends_b = [*end_a.tolist(), -1], [*end_b.tolist(), -2]
    mark_a, mark_b = bytearray(n), bytearray(m)
    link_a: list[int] = []
    link_b: list[int] = []
    i = j = 0
    while i < n:
        near = i + NEAR
        while i < near and ends_a[i] == ends_b[j]:
            i += 1
            j += 1
        if i == near:
            step, grows = NEAR, True
            while step:
                run = bytes_a[4 * i:4 * (i + step)]
                if run and run == bytes_b[4 * j:4 * (j + step)]:
                    size = len(run) // 4
                    i, j = i + size, j + size
                    step = 2 * step if grows else step // 2
                else:
                    grows, step = False, step // 2
        if i == n:
            break
        x, y = i, j
        link_a.append(x)
        link_b.append(y)
        while ends_a[x] != ends_b[y]:
            if ends_a[x] < ends_b[y]:
                mark_a[x] = 2
                x += 1
            else:
                mark_b[y] = 2
                y += 1
            link_a.append(x)
            link_b.append(y)
        mark_a[x] = mark_b[y] = 1
        i, j = x + 1, y + 1
    return np.frombuffer(mark_a, np.uint8), np.frombuffer(mark_b, np.uint8), link_a, link_b


class Aligned:
    """A slice of texts, aligned: ids and marks of all its tokens in one row each side."""

    def __init__(self, a: Side, b: Side, texts: list[str]) -> None:
        self.sides = a, b
        parts, distinct = split(texts)
        ids = a.encode(parts, distinct), b.encode(parts, distinct)
        # A text that one side does not give back has no tokens on either.
        none = [not len(x) or not len(y) for x, y in zip(*ids)]
        self.ids, self.counts = [], []
        for of in ids:
            of = [x[:0] if gone else x for x, gone in zip(of, none)]
            self.counts.append(np.array([len(x) for x in of], np.int64))
            self.ids.append(np.concatenate(of).astype(np.int64) if of else np.zeros(0, np.int64))
        begins = [np.cumsum(c) - c for c in self.counts]
        marks, links = ([], []), ([], [])
        for k in range(len(texts)):
            own = [x[s:s + c] for x, s, c in zip(self.ids, (begins[0][k], begins[1][k]), (c[k] for c in self.counts))]
            found = align(*[np.cumsum(s.size[x]) for s, x in zip(self.sides, own)])
            for at in range(2):
                marks[at].append(found[at])
                links[at].append(np.array(found[2 + at], np.int64) + begins[at][k])
        self.marks = [np.concatenate(m) if m else np.zeros(0, np.uint8) for m in marks]
        more = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in links]
        self.link_a, self.link_b = (
            np.append(np.flatnonzero(m == 0), x) for m, x in zip(self.marks, more)
        )
        self.text_of_link = np.repeat(np.arange(len(texts)), self.counts[0])[self.link_a]
        self.n_groups = np.bincount(
            np.repeat(np.arange(len(texts)), self.counts[0])[self.marks[0] < 2], minlength=len(texts)
        )

    def groups(self) -> list[bytes]:
        """Per text its groups, ``a1,a2|b1;a3|b2,b3`` in decimal ids."""
        last = [m < 2 for m in self.marks]
        group = [np.cumsum(x) - x for x in last]
        end_a = np.flatnonzero(last[0]) + 1
        begin_b = np.append(0, np.flatnonzero(last[1]) + 1)
        places = np.arange(len(last[0])) + begin_b[group[0]], np.arange(len(last[1])) + end_a[group[1]]
        width = max(s.width for s in self.sides)
        total = len(last[0]) + len(last[1])
        cells, sizes = np.zeros((total, width), np.uint8), np.zeros(total, np.int64)
        for s, ids, place, ends, stop in zip(self.sides, self.ids, places, last, b"|;"):
            cells[place, :s.width] = s.name[ids]
            sizes[place] = s.digits[ids]
            cells[place, s.digits[ids]] = np.where(ends, stop, ord(","))
        flat = cells[np.arange(width) <= sizes[:, None]].tobytes()
        tokens = np.append(0, np.cumsum(self.counts[0] + self.counts[1]))
        bounds = np.append(0, np.cumsum(sizes + 1))[tokens].tolist()
        return [flat[s:max(s, e - 1)] for s, e in zip(bounds, bounds[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs per text, ``b << 32 | a`` in order, how often, and where each text's begin."""
        key = self.ids[1][self.link_b] << 32 | self.ids[0][self.link_a]
        order = np.lexsort((key, self.text_of_link))
        key, text = key[order], self.text_of_link[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(key)))
        return key[first], times, np.searchsorted(text[first], np.arange(len(self.counts[0]) + 1))


def pack_pairs(key: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted pairs and their counts as planes of bytes, which compress well side by side."""
    b, a = key >> 32, key & 0xFFFFFFFF
    cells = np.stack([np.diff(b, prepend=0), a, times]).astype("<u4")
    return cells.view(np.uint8).reshape(3, -1, 4).transpose(0, 2, 1).tobytes()


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(3, 4, -1).transpose(0, 2, 1)
    b, a, times = np.ascontiguousarray(planes).view("<u4")[..., 0].astype(np.int64)
    return np.cumsum(b) << 32 | a, times


def sum_pairs(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(times, first) if len(first) else times


def aligned_texts(
    docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, with_groups: bool
) -> DataFrame:
    """One numbered row per text: its counts, the digest of its groups and its id pairs."""
    kind = docs.schema[id_col].dataType.simpleString()
    counts = ["row", "n_a", "n_b", "n_groups", "n_links"]
    schema = f"id {kind}, " + ", ".join(f"{c} long" for c in counts) + ", digest string, pairs binary"
    schema += ", groups string" if with_groups else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side(path_a), side(path_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, to in slices(batch.column(1), TEXT_BYTES):
                part = batch.slice(at, to - at)
                found = Aligned(a, b, [t or "" for t in part.column(1).to_pylist()])
                key, times, begins = found.pairs()
                groups = found.groups()
                n_links = np.bincount(found.text_of_link, minlength=part.num_rows)
                cells = [part.column(0), pa.array(row + np.arange(part.num_rows))]
                cells += [pa.array(c.astype(np.int64)) for c in (*found.counts, found.n_groups, n_links)]
                cells.append(pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups]))
                spans = [slice(s, e) for s, e in zip(begins, begins[1:])]
                cells.append(pa.array([pack_pairs(key[s], times[s]) for s in spans], pa.binary()))
                if with_groups:
                    cells.append(pa.array([g.decode() for g in groups]))
                yield pa.RecordBatch.from_arrays(
                    cells, ["id", *counts, "digest", "pairs"] + ["groups"] * with_groups
                )
                row += part.num_rows

    return docs.select(col(id_col), col(text_col)).mapInArrow(run, schema)


def pair_totals(aligned: DataFrame) -> DataFrame:
    """``key, n``: how many links of all texts hold an id pair; tasks add up theirs first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [], []

        def total() -> tuple[np.ndarray, np.ndarray]:
            key, times = sum_pairs(*[np.concatenate(h) for h in held])
            held[0][:], held[1][:] = [key], [times]
            return key, times

        size = 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                key, times = unpack_pairs(data)
                held[0].append(key)
                held[1].append(times)
                size += len(key)
                if size > 2 * PARTIAL:
                    key, times = total()
                    if (size := len(key)) > PARTIAL:
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(times)], ["key", "n"])
                        held, size = ([], []), 0
        if held[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in total()], ["key", "n"])

    partial = aligned.select("pairs").mapInArrow(add, "key long, n long")
    return partial.groupBy("key").agg(F.sum("n").alias("n"))


def place_in(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in a sorted table, and whether it does."""
    if not len(table):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return at, table[at] == key


def frequent_sums(aligned: DataFrame, table: dict[str, np.ndarray]) -> DataFrame:
    """The rows of ``aligned`` with sums over their frequent pairs in place of the pairs."""
    shared = aligned.sparkSession.sparkContext.broadcast(table)
    keep = [f for f in aligned.schema if f.name != "pairs"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            best, total = [], []
            for data in batch.column("pairs").to_pylist():
                key, times = unpack_pairs(data)
                at, hit = place_in(known["key"], key)
                at, times = at[hit], times[hit]
                best.append(int(times[known["best"][at]].sum()))
                total.append(int((times * known["n"][at]).sum()))
            cells = [batch.column(f.name) for f in keep]
            cells += [pa.array(best, pa.int64()), pa.array(total, pa.int64())]
            yield pa.RecordBatch.from_arrays(cells, [f.name for f in keep] + ["n_best", "count_sum"])

    return aligned.mapInArrow(add, f"{schema}, n_best long, count_sum long")


def rare_pairs(aligned: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``row, key, times`` of the pairs that are not among the frequent ones."""
    shared = aligned.sparkSession.sparkContext.broadcast(frequent)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key, times = unpack_pairs(data)
                miss = ~place_in(shared.value, key)[1]
                if miss.any():
                    cells = [np.full(miss.sum(), row), key[miss], times[miss]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["row", "key", "times"])

    return aligned.select("row", "pairs").mapInArrow(find, "row long, key long, times long")


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
    with_groups: bool = False, frequent: int = FREQUENT,
) -> DataFrame:
    """Alignment of tokenizers A and B over every text, one row per row of ``docs``.

    A tokenizer is a file: byte-level BPE of the ``tokenizers`` format, given a space and
    the text, or a ``.model`` of sentencepiece, which sets the space itself.  Special tokens
    in texts are plain text.  Tokens whose bytes overlap are linked; places where tokens of
    both end cut a text into groups.  Columns: the id, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best`` (links whose id pair is linked as often as any of its B id, over
    all texts), ``count_sum`` (over its links, how often the id pair is linked in all texts),
    ``digest`` (SHA-256 of the groups, empty without tokens) and, on request, ``groups``:
    ``a1,a2|b1;a3|b2,b3``.

    A text that is null or empty, or that one side's tokens do not spell, has no tokens and
    zeros.  Null and repeated ids stay as they are, rows are told apart by their place.  No
    rows give no rows.  Texts are cut where both sides begin a token anyway, and words are
    encoded once per worker, as long as it remembers them.

    Texts are tokenized once; what is kept of them are distinct id pairs, compressed.  Counts
    of the ``frequent`` commonest pairs are broadcast (16 MB at most), the others, of which
    none is common, are joined.  Best counts are one number per B id.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    found = aligned_texts(docs, path_a, path_b, id_col, text_col, with_groups)
    found.write.option("compression", "zstd").parquet(path)
    aligned = spark.read.schema(found.schema).parquet(path)
    totals = materialize(pair_totals(aligned))
    # One row per id of B.
    of_b = F.shiftright("key", 32)
    best = totals.groupBy(of_b.alias("b")).agg(F.max("n").alias("most")).toArrow()
    most = np.zeros(1 + max(best["b"].to_pylist(), default=0), np.int64)
    most[best["b"].to_numpy()] = best["most"].to_numpy()
    top = totals.orderBy(F.col("n").desc(), "key").limit(frequent).toArrow()
    order = np.argsort(top["key"].to_numpy())
    key, n = top["key"].to_numpy()[order], top["n"].to_numpy()[order]
    sums = frequent_sums(aligned, {"key": key, "n": n, "best": n == most[key >> 32]})
    if len(key) == frequent:
        highest = totals.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))
        rest = rare_pairs(aligned, key).join(totals, "key").withColumn("b", of_b)
        rest = rest.join(F.broadcast(highest), "b").groupBy("row").agg(
            F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("_best"),
            F.sum(F.col("times") * F.col("n")).alias("_sum"),
        )
        sums = sums.join(rest, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0)),
        }).drop("_best", "_sum")
    return sums.drop("row").withColumnRenamed("id", id_col)
