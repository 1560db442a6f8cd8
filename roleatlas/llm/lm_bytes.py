"""Language-model scores of texts by byte PPM whose contexts run over white space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import col, fresh
from .words import LOWER, find_words, slices, text_bytes

# Contexts: the last ORDER bytes of the text, then ever fewer of them, down to none.
ORDER = 5
# A byte is coded as its value plus 1; 0 stands before the text. ORDER + 1 of them are a gram.
BITS, TEXT_END, SYMBOLS = 9, 257, 257
# Orders up to LOW are counted as a whole: (SYMBOLS + 1) ** (LOW + 1) rows at most. A group
# of the others has the grams of whole contexts of LOW + 1 bytes, whatever the corpus.
LOW = 2
WORD, GRAM = 0, 1
# The most frequent words and grams are scored where the text is read, the others by a join.
FREQUENT_WORDS, FREQUENT_GRAMS = 1 << 18, 1 << 20
PART_GRAMS = 300_000
HELD_KEYS = 1 << 20
SLICE_BYTES = 1 << 20


def mask(order: int) -> int:
    """The bits of a symbol and the last ``order`` bytes before it."""
    return (1 << BITS * (order + 1)) - 1


def text_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A gram for each byte and the end of each text, and whose it is."""
    data, offsets = text_bytes(texts)
    size = np.diff(offsets) + 1
    first = np.cumsum(size) - size
    symbol = np.full(int(size.sum()), TEXT_END, np.int64)
    inside = np.ones(len(symbol), bool)
    inside[first + size - 1] = False
    symbol[inside] = LOWER[data].astype(np.int64) + 1
    gram = symbol.copy()
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(symbol)) - np.repeat(first, size)
    for k in range(1, ORDER + 1):
        gram[k:] |= np.where(place[k:] >= k, symbol[:-k], 0) << BITS * k
    return gram, text


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sum of each."""
    if not len(key):
        return key, n
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(n, first)


def key_counts(docs: DataFrame, training: Column, text_col: str) -> DataFrame:
    """``kind, key, n``: every distinct word hash and gram, with its count in training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {WORD: [], GRAM: []}

        def give(kind: int, most: int) -> Iterator[pa.RecordBatch]:
            if sum(len(key) for key, _ in held[kind]) <= most:
                return
            key, n = summed(*(np.concatenate(x) for x in zip(*held[kind])))
            held[kind] = [(key, n)]
            if 2 * len(key) > most:
                held[kind] = []
                for k in range(0, len(key), 100_000):
                    cells = [np.full(len(key[k:k + 100_000]), kind, np.int32), key[k:k + 100_000], n[k:k + 100_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["kind", "key", "n"])

        for batch in batches:
            for a, b in slices(batch.column(0), SLICE_BYTES):
                part = batch.slice(a, b - a)
                learnt = part.column(1).to_numpy(zero_copy_only=False)
                words = find_words(part.column(0))
                gram, text = text_grams(part.column(0))
                for kind, key, of in ((WORD, words.hash.view(np.int64), words.text), (GRAM, gram, text)):
                    in_training = learnt[of]
                    found, n = np.unique(key[in_training], return_counts=True)
                    held[kind].append((found, n))
                    other = np.unique(key[~in_training])
                    held[kind].append((other, np.zeros(len(other), np.int64)))
                    yield from give(kind, HELD_KEYS)
        for kind in held:
            yield from give(kind, 0)

    rows = docs.select(col(text_col), training.alias("training"))
    partial = rows.mapInArrow(count, "kind int, key long, n long")
    return partial.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Level:
    """Training counts of symbols after contexts of one order."""

    def __init__(self, key: np.ndarray, n: np.ndarray) -> None:
        self.key, self.n = summed(key, n)
        context = self.key >> BITS
        self.first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(context) else context
        self.context = context[self.first]
        self.kinds = np.diff(np.append(self.first, len(context)))
        self.total = self.sums(self.n)

    def sums(self, of_keys: np.ndarray) -> np.ndarray:
        """Per context."""
        return np.add.reduceat(of_keys, self.first) if len(self.first) else of_keys

    @staticmethod
    def at(sorted_: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Values of the wanted keys; 0 for unknown ones."""
        if not len(sorted_):
            return np.zeros(len(wanted), np.int64)
        place = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
        return np.where(sorted_[place] == wanted, values[place], 0)


def gram_scores(gram: np.ndarray, n: np.ndarray, low: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 of the probability of the last symbol of each gram after the others.

    ``gram`` holds all grams of its contexts of LOW + 1 bytes, ``low`` the counts of the
    order LOW over all texts.  What follows a context also follows each shorter one, so
    the symbols to exclude at an order are just those seen at the next higher one.
    """
    seen = n > 0
    levels = [
        Level(gram[seen] & mask(k), n[seen]) if k > LOW else Level(low[0] & mask(k), low[1]) for k in range(ORDER + 1)
    ]
    out, done = np.zeros(len(gram)), np.zeros(len(gram), bool)
    gone_total, gone_kinds = np.zeros((2, len(gram)), np.int64)
    for k in range(ORDER, -1, -1):
        level = levels[k]
        key = gram & mask(k)
        mine = level.at(level.key, level.n, key)
        kinds = level.at(level.context, level.kinds, key >> BITS)
        left = level.at(level.context, level.total, key >> BITS) - gone_total
        left_kinds = kinds - gone_kinds
        open_ = ~done & (left > 0)
        value = np.where(mine > 0, mine, left_kinds)[open_]
        out[open_] += np.log10(value / (left + left_kinds)[open_])
        done |= mine > 0
        if k:
            lower = levels[k - 1]
            excluded = level.sums(lower.at(lower.key, lower.n, level.key & mask(k - 1)))
            gone_total, gone_kinds = level.at(level.context, excluded, key >> BITS), kinds
    if not done.all():
        out[~done] -= np.log10(SYMBOLS - len(levels[0].key))
    return out


def score_grams(grams: DataFrame, parts: int) -> DataFrame:
    """``key, n, p``: grams by their contexts of LOW + 1 bytes, so that a part has these whole."""
    low = grams.filter("n > 0").groupBy(F.expr(f"key & {mask(LOW)}L").alias("key")).agg(F.sum("n").alias("n")).toArrow()
    counts = low["key"].to_numpy(), low["n"].to_numpy()

    def score(group: pa.Table) -> pa.Table:
        key, n = group["key"].to_numpy(), group["n"].to_numpy()
        return pa.table({"key": key, "n": n, "p": gram_scores(key, n, counts)})

    context = F.expr(f"(key & {mask(LOW + 1)}L) div {1 << BITS}")
    placed = grams.select("key", "n", F.pmod(F.xxhash64(context), F.lit(parts)).alias("part"))
    return placed.groupBy("part").applyInArrow(score, "key long, n long, p double")


def frequent_rows(scored: DataFrame, kind: int, most: int) -> dict[str, np.ndarray]:
    top = scored.filter(F.col("kind") == kind).select("key", "n", "p")
    top = top.orderBy(F.col("n").desc(), "key").limit(most).toArrow()
    order = np.argsort(top["key"].to_numpy())
    return {c: top[c].to_numpy()[order] for c in top.column_names}


def text_rows(
    docs: DataFrame, id_col: str, text_col: str, words: dict[str, np.ndarray], grams: dict[str, np.ndarray],
) -> DataFrame:
    """A row of sums per text over its frequent words and grams, and a row per other one of it.

    ``row`` numbers the texts; ``key`` of a row of sums is arbitrary, so that these rows
    spread like the others, and its kind is none.
    """
    kind_of_id = docs.schema[id_col].dataType.simpleString()

    def sort_out(table: dict[str, np.ndarray], key: np.ndarray, text: np.ndarray, values: list[np.ndarray], texts: int):
        """Sums per text of each of the values of frequent keys; other keys: text, key, times."""
        found, inverse = np.unique(key, return_inverse=True)
        if len(table["key"]):
            at = np.minimum(np.searchsorted(table["key"], found), len(table["key"]) - 1)
            hit = table["key"][at] == found
        else:
            at, hit = np.zeros(len(found), np.int64), np.zeros(len(found), bool)
        sums = [np.bincount(text, np.where(hit, v[at], 0)[inverse], texts) if len(v) else np.zeros(texts) for v in values]
        rest = np.flatnonzero(~hit[inverse])
        rest = rest[np.lexsort((inverse[rest], text[rest]))]
        new = np.ones(len(rest), bool)
        new[1:] = (inverse[rest][1:] != inverse[rest][:-1]) | (text[rest][1:] != text[rest][:-1])
        first = np.flatnonzero(new)
        return sums, text[rest[first]], key[rest[first]], np.diff(np.append(first, len(rest)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        word_values = [(words["n"] > 0).astype(np.int64), np.log10(words["n"] + 1.0)]
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                ids, part = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
                texts = len(ids)
                own = find_words(part)
                (known, base), of_word, word, word_times = sort_out(
                    words, own.hash.view(np.int64), own.text, word_values, texts)
                (p,), of_gram, gram, gram_times = sort_out(grams, *text_grams(part), [grams["p"]], texts)
                rows = row + np.arange(texts)
                more = len(word) + len(gram)
                nothing = np.zeros(more)
                cells = [
                    pa.array(np.concatenate([rows, row + of_word, row + of_gram])),
                    pa.concat_arrays([ids, pa.nulls(more, ids.type)]),
                    pa.array(np.repeat(np.array([-1, WORD, GRAM], np.int32), [texts, len(word), len(gram)])),
                    pa.array(np.concatenate([rows * 0x9E3779B97F4A7C1 & 0x7FFFFFFFFFFFFFFF, word, gram])),
                    pa.array(np.concatenate([np.zeros(texts, np.int64), word_times, gram_times]).astype(np.int32)),
                    pa.array(np.append(np.bincount(own.text, minlength=texts), nothing).astype(np.int64)),
                    pa.array(np.append(known, nothing).astype(np.int64)),
                    pa.array(np.append(base, nothing)), pa.array(np.append(p, nothing)),
                ]
                yield pa.RecordBatch.from_arrays(
                    cells, ["row", "id", "kind", "key", "times", "n_tokens", "n_known", "base", "p"]
                )
                row += texts

    return docs.select(col(id_col), col(text_col)).mapInArrow(
        read, f"row long, id {kind_of_id}, kind int, key long, times int, n_tokens long, n_known long, base double, p double"
    )


def byte_lm_scores(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """log10 probability of every text under byte PPM learnt from the ``training`` rows.

    The symbols are the bytes of the text, A-Z lowered and white space as it is, and one
    text end.  The context of a symbol is the last ORDER bytes, over white space, with
    what is before the text as a byte of its own; a symbol that was not seen there costs
    an escape (the number of kinds seen over their count plus that number) and is looked
    for after ever fewer bytes, each time without the symbols of the contexts before, and
    at last among all that are left.  A symbol's probability follows from its gram, the
    ORDER bytes before it and itself, so distinct grams are counted and scored, and texts
    add up theirs.

    Columns: the id, ``n_tokens``, ``n_known`` (tokens seen in training), ``train_tokens``,
    ``base_score`` (add-one unigram of words) and ``score``.  Tokens are words and one
    text end.

    Frequent words and grams (tables of fixed size) are added where the text is read, all
    others by a join, so none is a hot key.  Grams are exact; words are told apart by
    64 bits of hash.  Nulls: a null text is empty and has the text end alone; null ids
    stay, and each row is scored by itself, repeated ids or not.  Without training
    texts every symbol is alike.  No rows give no rows.
    """
    (flag,) = fresh(docs, "_training")
    docs = docs.select(col(id_col), col(text_col), F.coalesce(training, F.lit(False)).alias(flag))
    counted = materialize(key_counts(docs, col(flag), text_col))
    word = F.col("kind") == WORD
    totals = counted.agg(
        F.coalesce(F.sum(F.when(word, F.col("n"))), F.lit(0)).alias("n"),
        F.count_if(word & (F.col("n") > 0)).alias("kinds"), F.count_if(~word).alias("grams"),
    ).first()
    ends = docs.filter(col(flag)).count()
    tokens, kinds = totals["n"] + ends, totals["kinds"] + (ends > 0)
    grams = score_grams(counted.filter(~word), max(1, -(-totals["grams"] // PART_GRAMS)))
    words = counted.filter(word).select(F.lit(WORD).alias("kind"), "key", "n", F.lit(0.0).alias("p"))
    scored = materialize(words.unionByName(grams.select(F.lit(GRAM).alias("kind"), "key", "n", "p")))
    rows = text_rows(
        docs, id_col, text_col,
        frequent_rows(scored, WORD, FREQUENT_WORDS), frequent_rows(scored, GRAM, FREQUENT_GRAMS),
    )
    known = scored.withColumnsRenamed({"n": "key_n", "p": "key_p"})
    is_word, is_gram = F.col("kind") == WORD, F.col("kind") == GRAM
    valued = rows.join(known, ["kind", "key"], "left").select(
        "row", "id", "n_tokens",
        F.when(is_word & (F.col("key_n") > 0), F.col("times")).otherwise(F.col("n_known")).alias("n_known"),
        F.when(is_word, F.col("times") * F.log10(F.col("key_n") + 1.0)).otherwise(F.col("base")).alias("base"),
        F.when(is_gram, F.col("times") * F.col("key_p")).otherwise(F.col("p")).alias("p"),
    )
    sums = valued.groupBy("row").agg(
        F.max("id").alias("id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "p")]
    )
    floor = float(np.log10(tokens + kinds + 1))
    return sums.select(
        F.col("id").alias(id_col), (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + int(ends > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(float(np.log10(ends + 1))) - (F.col("n_tokens") + 1) * floor).alias("base_score"),
        F.col("p").alias("score"),
    )
