"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import col, fresh
from .words import BASE, INVERSE, Words, find_words, mix, powers, slices

BUCKETS = 1 << 20
FEATURES = 2048
# At most so many confirmed and so many unlabelled texts are fitted on.
POSITIVES = 6000
UNLABELLED = 14000
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
PRIOR_TEXTS = 10.0
# Words are runs of ASCII letters and of bytes beyond ASCII.
NOT_LETTERS = np.array([not (chr(b).isalpha() if b < 128 else True) for b in range(256)])


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    text = F.coalesce(col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(parts))


def buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of every word, itself and its beginnings, and their texts."""
    found, texts = [words.hash % np.uint64(BUCKETS)], [words.text]
    n = len(words.data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((words.data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    for size in PREFIXES:
        longer = np.flatnonzero(words.end - words.start > size)
        start = words.start[longer]
        part = mix((sums[start + size] - sums[start]) * powers(INVERSE, max(n, 1))[start])
        found.append((part ^ np.uint64(size * 0x9E3779B9)) % np.uint64(BUCKETS))
        texts.append(words.text[longer])
    return np.concatenate(found).astype(np.int64), np.concatenate(texts)


def present(texts: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs among the ``wanted`` buckets (a mask)."""
    bucket, text = buckets(find_words(texts, NOT_LETTERS))
    hit = np.flatnonzero(wanted[bucket])
    pairs = np.unique(text[hit] * BUCKETS + bucket[hit])
    return pairs // BUCKETS, pairs % BUCKETS


def sample_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts to fit on: ``positive`` confirmed toxic ones, the rest taken as unlabelled.

    Both are the first by a hash of the id, POSITIVES and UNLABELLED at most; the
    unlabelled ones are drawn without a look at their label.
    """
    one = labels.groupBy(col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("id"), F.col("id")]
    confirmed = one.filter("toxic = 1").orderBy(*order).limit(POSITIVES)
    unlabelled = one.orderBy(*order).limit(UNLABELLED)
    chosen = confirmed.select("id", F.lit(True).alias("positive")).unionAll(
        unlabelled.select("id", F.lit(False).alias("positive"))
    )
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "id")  # POSITIVES + UNLABELLED ids at most


def first_weights(p: np.ndarray, u: np.ndarray, n: tuple[int, int], prior: float) -> np.ndarray:
    """Weight of evidence of features in ``p`` confirmed and ``u`` unlabelled of ``n`` texts.

    The share of toxic texts among the unlabelled ones with a feature is what the
    confirmed texts lead to expect over what was counted, with PRIOR_TEXTS texts of the
    common share added, so that a feature seen a few times says little.
    """
    expected = prior * n[1] * p / n[0]
    share = np.clip((expected + prior * PRIOR_TEXTS) / (u + PRIOR_TEXTS), 1e-4, 0.995)
    return np.log(share / (1 - share)) - np.log(prior / (1 - prior))


def screen(sample: DataFrame, n: tuple[int, int], prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The FEATURES buckets with the most evidence for toxicity, and their first weights."""
    everything = np.ones(BUCKETS, bool)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                text, bucket = present(part.column(1), everything)
                label = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                counts += np.bincount(label[text] * BUCKETS + bucket, minlength=2 * BUCKETS).reshape(2, BUCKETS)
        used = np.flatnonzero(counts[1])
        other = np.flatnonzero(counts[0])
        cells = [
            pa.array(np.append(used, other)),
            pa.array(np.append(counts[1, used], np.zeros_like(other))),
            pa.array(np.append(np.zeros_like(used), counts[0, other])),
        ]
        yield pa.RecordBatch.from_arrays(cells, ["bucket", "p", "u"])

    counted = sample.select("positive", "text").mapInArrow(count, "bucket long, p long, u long")
    seen = counted.groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).filter("p >= 2")
    # One row per bucket at most.
    rows = seen.toArrow().sort_by("bucket")
    bucket, p, u = (rows[c].to_numpy() for c in ("bucket", "p", "u"))
    weight = first_weights(p, u, n, prior)
    best = np.argsort(-(weight * np.sqrt(p)), kind="stable")[:FEATURES]
    best = np.sort(best[weight[best] > 0])
    return bucket[best], weight[best]


def design(sample: DataFrame, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fitted rows' labels, and (row, feature) pairs of the features that they have."""
    wanted = np.zeros(BUCKETS, bool)
    wanted[features] = True

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                text, bucket = present(part.column(1), wanted)
                ends = np.searchsorted(text, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket))
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), part.column(0), lists], ["id_hash", "positive", "buckets"]
                )

    rows = sample.select("positive", "text", F.xxhash64("id").alias("id_hash")).mapInArrow(
        reduce, "id_hash long, positive boolean, buckets array<bigint>"
    ).collect()  # POSITIVES + UNLABELLED rows at most, FEATURES numbers each
    rows.sort(key=lambda r: (r["positive"], r["id_hash"], r["buckets"]))
    row = np.repeat(np.arange(len(rows)), [len(r["buckets"]) for r in rows])
    bucket = np.array([b for r in rows for b in r["buckets"]], np.int64)
    return np.array([r["positive"] for r in rows], bool), row, np.searchsorted(features, bucket)


def fit_nnpu(
    positive: np.ndarray, row: np.ndarray, feature: np.ndarray, first: np.ndarray, prior: float,
    seed: int = 0, steps: int = 1500, rate: float = 0.05, decay: float = 2e-4,
) -> tuple[np.ndarray, float]:
    """A linear classifier of least non-negative risk over rows with 0/1 features.

    With loss l(z) = log(1 + exp(-z)) the risk is prior * E_P l(z) + max(0, E_U l(-z)
    - prior * E_P l(-z)).  Where the second part is negative, the step goes back up
    it, so the confirmed texts can't be told apart by heart.  Rows are weighted by a
    bootstrap that the seed draws.
    """
    times = np.random.default_rng(seed).poisson(1.0, len(positive)).astype(float)
    ours, theirs = times * positive, times * ~positive
    ours, theirs = ours / max(ours.sum(), 1), theirs / max(theirs.sum(), 1)
    w, b = first.astype(float).copy(), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        z = np.clip(np.bincount(row, w[feature], len(positive)) + b, -40, 40)
        like = 1 / (1 + np.exp(-z))
        cost = np.logaddexp(0, z)
        negative = theirs @ cost - prior * (ours @ cost)
        # Derivatives by z: of l(z) it is like - 1, of l(-z) it is like.
        up = prior * ours * (like - 1)
        down = theirs * like - prior * ours * like
        dz = up + down if negative >= 0 else -down
        grad = np.append(np.bincount(feature, dz[row], len(w)) + decay * w, dz.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    prior: float | None = None, members: int = 3,
) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Features, their weights and the bias: the mean of ``members`` classifiers.

    The prior is the share of toxic rows of ``labels`` unless it is given.  Without
    a confirmed or an unlabelled text there is no model.
    """
    sample = materialize(sample_rows(docs, labels, id_col, text_col))
    counts = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if prior is None:
        prior = labels.agg(F.avg(F.when(F.col("toxic") == 1, 1.0).otherwise(0.0))).first()[0]
    if not counts.get(True) or not counts.get(False) or not prior:
        return None
    prior = min(max(prior, 0.001), 0.9)
    features, first = screen(sample, (counts[True], counts[False]), prior)
    positive, row, feature = design(sample, features)
    fits = [fit_nnpu(positive, row, feature, first, prior, seed) for seed in range(members)]
    weights = np.mean([w for w, _ in fits], axis=0)
    return features, weights, float(np.mean([b for _, b in fits]))


def score_toxicity(
    docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None,
    text_col: str = "text", score_col: str = "score",
) -> DataFrame:
    """``docs`` with a score from 0 to 1 of each whole text, appended as the last column."""
    (score,) = fresh(docs, score_col)
    if model is None:
        return docs.withColumn(score, F.lit(0.0))
    features, weights, bias = model
    at = docs.columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weight = np.zeros(BUCKETS, bool), np.zeros(BUCKETS)
        wanted[features], weight[features] = True, weights
        for batch in batches:
            for a, b in slices(batch.column(at)):
                part = batch.slice(a, b - a)
                text, bucket = present(part.column(at), wanted)
                logit = bias + np.bincount(text, weight[bucket], part.num_rows)
                values = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(values)], [*part.schema.names, score]
                )

    schema = docs.select("*", F.lit(0.0).alias(score)).schema
    return docs.mapInArrow(apply, schema)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    score_col: str = "score",
) -> DataFrame:
    """Learn from the ids whose :func:`fold` of 3 is not 1, then score every text of ``docs``.

    Only the text enters a score.  Nulls: a null or empty text has no feature and
    gets the bias alone; null labels confirm nothing; repeated label rows of an id
    count once, as toxic if one is.  Rows that repeat are scored alike.  Without
    labels all scores are 0.  No rows give no rows.
    """
    learnt = labels.filter(fold(id_col, 3) != 1)
    model = fit_toxicity(docs.filter(fold(id_col, 3) != 1), learnt, id_col, text_col)
    return score_toxicity(docs, model, text_col, score_col)
