"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import col, keep_ids
from .components import components
from .words import find_words, mix, slices

SHINGLE = 5
THRESHOLD = 0.8
# A pair of similarity 0.8 shares a band of three samples with probability 1 - (1 - 0.8**3)**10 > 0.999.
BANDS, ROWS = 10, 3
# Words are counted by buckets of their hash: a table of fixed size, whatever the corpus.
IDF_BUCKETS = 1 << 18
BLOCK = 400


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """``n`` even quantiles of Gamma(2, 1), whose distribution is 1 - (1 + x) exp(-x)."""
    wanted, low, high = (np.arange(n) + 0.5) / n, np.zeros(n), np.full(n, 64.0)
    for _ in range(60):
        mid = (low + high) / 2
        above = 1 - (1 + mid) * np.exp(-mid) > wanted
        low, high = np.where(above, low, mid), np.where(above, mid, high)
    return low.astype(np.float32)


STEP = odd_numbers(SHINGLE, 1)
SAMPLE = odd_numbers(BANDS * ROWS, 2)
JOIN = odd_numbers(ROWS, 3)
TURN = np.uint64(0xD6E8FEB86659FD93)
GAMMA = gamma_quantiles()
LOG_GAMMA = np.log(GAMMA)


def word_idf(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """1 + ln((texts + 1) / (texts with a word of the bucket + 1)), per bucket, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts = np.zeros(IDF_BUCKETS, np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for a, b in slices(batch.column(0)):
                words = find_words(batch.column(0).slice(a, b - a))
                keys = words.text * IDF_BUCKETS + (words.hash % np.uint64(IDF_BUCKETS)).astype(np.int64)
                counts += np.bincount(np.unique(keys) % IDF_BUCKETS, minlength=IDF_BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(counts[used], texts))], ["bucket", "n"]
        )

    counted = docs.select(col(text_col)).mapInArrow(count, "bucket long, n long")
    # One row per bucket and one for the number of texts.
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    texts = n[bucket == -1].sum()
    counts = np.zeros(IDF_BUCKETS)
    counts[bucket[bucket >= 0]] = n[bucket >= 0]
    return (1 + np.log((texts + 1) / (counts + 1))).astype(np.float32)


def weighted_shingles(texts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, their weights, and where each text's begin.

    A shingle is five words in a row; a text of one to four words is one shingle.
    Its weight is its count in the text times the mean idf of its words.
    """
    words = find_words(texts)
    n = len(words.hash)
    rarity = idf[(words.hash % np.uint64(IDF_BUCKETS)).astype(np.int64)].astype(np.float64)
    per_text = np.bincount(words.text, minlength=len(texts))
    begin = np.cumsum(per_text) - per_text
    last = max(n - SHINGLE + 1, 0)
    at = np.flatnonzero(words.text[:last] == words.text[n - last:])
    shingle, weight = np.zeros(len(at), np.uint64), np.zeros(len(at))
    for j in range(SHINGLE):
        shingle += words.hash[at + j] * STEP[j]
        weight += rarity[at + j]
    weight /= SHINGLE
    text = words.text[at]
    short = np.flatnonzero((per_text > 0) & (per_text < SHINGLE))
    if len(short):
        spans = [slice(begin[t], begin[t] + per_text[t]) for t in short]
        shingle = np.append(shingle, [(words.hash[s] * STEP[:s.stop - s.start]).sum() for s in spans])
        weight = np.append(weight, [rarity[s].mean() for s in spans])
        text = np.append(text, short)
    shingle = mix(shingle.astype(np.uint64))
    order = np.lexsort((shingle, text))
    shingle, weight, text = shingle[order], weight[order], text[order]
    new = np.ones(len(order), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(order)))
    begins = np.searchsorted(text[first], np.arange(len(texts) + 1))
    return shingle[first], weight[first] * times, begins


def samples(shingle: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Consistent weighted samples of the texts that begin at ``starts``, one row each.

    For every sample, an item of weight w draws r and c from Gamma(2, 1) and b from
    [0, 1) by its hash, and has t = floor(ln w / r + b) and the value ln c - r (t - b + 1);
    the item of least value is taken, with its t.  Two texts take the same with the
    probability of their weighted Jaccard similarity.
    """
    log_weight = np.log(weight).astype(np.float32)
    counts = np.diff(np.append(starts, len(shingle)))
    out = np.empty((len(starts), len(SAMPLE)), np.uint64)
    low = np.uint64(0xFFFF)
    for k, odd in enumerate(SAMPLE):
        h = shingle * odd
        h ^= h >> np.uint64(32)
        r = GAMMA[(h >> np.uint64(48)).astype(np.int64)]
        c = LOG_GAMMA[((h >> np.uint64(32)) & low).astype(np.int64)]
        b = h.astype(np.uint32).astype(np.float32) * np.float32(2.0**-32)
        t = np.floor(log_weight / r + b)
        value = c - r * (t - b + 1)
        least = np.minimum.reduceat(value, starts)
        hits = np.flatnonzero(value == np.repeat(least, counts))
        at = hits[np.searchsorted(hits, starts)]
        out[:, k] = mix(shingle[at] + t[at].astype(np.int64).view(np.uint64) * TURN)
    return out


def band_keys(shingle: np.ndarray, weight: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which texts have shingles, and the keys of their bands."""
    some = np.flatnonzero(np.diff(begins))
    if not len(some):
        return some, np.zeros((0, BANDS), np.int64)
    found = samples(shingle, weight, begins[some]).reshape(len(some), BANDS, ROWS)
    return some, mix((found * JOIN).sum(axis=2, dtype=np.uint64)).view(np.int64)


def band_rows(docs: DataFrame, idf: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``id, digest, keys`` of every text; ``keys`` is null for a text without words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(2)):
                part = batch.slice(a, b - a)
                some, keys = band_keys(*weighted_shingles(part.column(2), idf))
                has = np.zeros(part.num_rows, bool)
                has[some] = True
                ends = np.append(0, np.cumsum(has * BANDS))
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(keys.ravel()), mask=pa.array(~has)
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), lists], ["id", "digest", "keys"]
                )

    text = F.coalesce(col(text_col), F.lit(""))
    chosen = docs.select(col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"), text)
    return chosen.mapInArrow(sign, f"id {kind}, digest binary, keys array<bigint>")


def similar(
    own: tuple[np.ndarray, np.ndarray], shingle: np.ndarray, weight: np.ndarray, starts: np.ndarray,
) -> np.ndarray:
    """Weighted Jaccard similarity of one text to each of the texts that begin at ``starts``."""
    mine, mine_weight = own
    at = np.searchsorted(mine, shingle)
    at[at == len(mine)] = 0
    shared = np.where(mine[at] == shingle, np.minimum(mine_weight[at], weight), 0)
    common = np.add.reduceat(shared, starts)
    return common / (mine_weight.sum() + np.add.reduceat(weight, starts) - common)


def links_to_leaders(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """Links ``a, b`` of leaders to similar members of their blocks.

    ``rows`` has ``leader, block, id, text``; each block begins with its leader's row.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, None
        for batch in batches:
            for a, b in slices(batch.column(3)):
                part = batch.slice(a, b - a)
                shingle, weight, begins = weighted_shingles(part.column(3), idf)
                leaders, ids = part.column(0).to_pylist(), part.column(2).to_pylist()
                found = []
                for i, (of, one) in enumerate(zip(leaders, ids)):
                    span = slice(begins[i], begins[i + 1])
                    if of == one:
                        leader, own = one, (shingle[span].copy(), weight[span].copy())
                    elif of == leader and span.stop > span.start:
                        if similar(own, shingle[span], weight[span], np.zeros(1, np.int64))[0] >= THRESHOLD:
                            found.append((of, one))
                if found:
                    cells = [pa.array(c, part.schema.field(2).type) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(cells, ["a", "b"])

    order = [F.col("leader"), F.col("block"), F.col("id") != F.col("leader"), F.col("id")]
    dealt = rows.repartition("leader", "block").sortWithinPartitions(*order)
    return dealt.select("leader", "block", "id", "text").mapInArrow(verify, f"a {kind}, b {kind}")


def links_within(ids: list, classes: list, texts: pa.Array, idf: np.ndarray) -> list[tuple]:
    """Links that join all classes which similar texts of a group connect.

    Texts are taken as leaders in the order of how common their shingles are here,
    so the original of many edited copies comes first.  A leader is compared with all
    texts that are in another class by then and have not led; only pairs already
    connected are left out.
    """
    shingle, weight, begins = weighted_shingles(texts, idf)
    sizes = np.diff(begins)
    _, which, count = np.unique(shingle, return_inverse=True, return_counts=True)
    common = np.zeros(len(ids))
    some = np.flatnonzero(sizes)
    if len(some):
        common[some] = np.add.reduceat(count[which].astype(float), begins[some]) / sizes[some]
    names = {c: i for i, c in enumerate(dict.fromkeys(classes))}
    group = np.array([names[c] for c in classes])
    open_, found = sizes > 0, []
    for i in np.argsort(-common, kind="stable"):
        open_[i] = False
        others = np.flatnonzero(open_ & (group != group[i]))
        if not sizes[i] or not len(others):
            continue
        own = (shingle[begins[i]:begins[i + 1]], weight[begins[i]:begins[i + 1]])
        counts = sizes[others]
        starts = np.cumsum(counts) - counts
        flat = np.arange(counts.sum()) + np.repeat(begins[others] - starts, counts)
        near = others[similar(own, shingle[flat], weight[flat], starts) >= THRESHOLD]
        for j in near:
            if group[j] != group[i]:
                found.append((ids[i], ids[j]))
                group[group == group[j]] = group[i]
    return found


def near_links(docs: DataFrame, rows: DataFrame, idf: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """Links ``a, b`` with the components of all similar pairs that share a band.

    First each bucket's least id leads, and all members are compared with it.  In
    buckets that this leaves in several classes, every pair across classes is decided
    in blocks of bounded size (:func:`links_within`).
    """
    kind = rows.schema["id"].dataType.simpleString()
    keys = rows.filter("keys IS NOT NULL").select("id", F.posexplode("keys").alias("band", "key"))
    sizes = keys.groupBy("band", "key").agg(
        F.min("id").alias("leader"), F.count(F.lit(1)).alias("n"),
        # Buckets of the same texts, in several bands, are known by this and taken once.
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("mark"),
    ).filter("n > 1")
    sizes = sizes.groupBy("leader", "n", "mark").agg(
        F.min(F.struct("band", "key")).alias("one")
    ).select("leader", "n", "one.*")
    members = materialize(keys.join(sizes, ["band", "key"]))
    wanted = members.select("id").distinct()
    texts = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    # The ids grow with the corpus, so they are merged with the texts at every size.
    texts = materialize(texts.join(wanted.hint("merge"), "id", "left_semi"))

    pairs = members.filter("id <> leader").select("leader", "id").distinct()
    blocks = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = pairs.join(blocks, "leader").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    heads = blocks.select("leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    placed = placed.select("leader", "block", "id").unionByName(heads.withColumn("id", F.col("leader")))
    first = materialize(links_to_leaders(placed.join(texts, "id"), idf).distinct())

    classes = components(first)
    rest = members.filter("n > 2 AND id <> leader").join(classes, "id", "left")
    rest = rest.withColumn("class", F.coalesce("class", "id"))
    several = rest.groupBy("band", "key").agg(
        F.min("class").alias("low"), F.max("class").alias("high"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
    ).filter("low <> high").drop("low", "high")
    rest = rest.join(several, ["band", "key"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rest = rest.withColumn("other", other).filter("blocks = 1 OR block <> other")
    rest = rest.select(
        "band", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "id", "class",
    )

    def decide(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("id")
        text = group["text"].chunk(0) if group.num_rows else pa.array([], pa.string())
        found = links_within(group["id"].to_pylist(), group["class"].to_pylist(), text, idf)
        kind_of = group.schema.field("id").type
        return pa.table({k: pa.array([f[n] for f in found], kind_of) for n, k in enumerate("ab")})

    second = rest.join(texts, "id").groupBy("band", "key", "low", "high").applyInArrow(
        decide, f"a {kind}, b {kind}"
    )
    return first.unionAll(materialize(second.distinct()))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``copy_of`` and ``class_id``.

    ``copy_of`` is the least id with the very same text; only these texts are signed
    and compared.  Two texts are linked when their weighted Jaccard similarity is 0.8
    or more; a class is a connected component, named by its least id.

    Nulls: a null text is empty; texts without words are near to no other text, only
    equal to equal ones; a row without an id has the class of its text, null if no
    equal text has an id.  A row is known by its id; repeated rows fall into one
    class.  Ties do not arise, every choice is by least id.  No rows give no rows.
    """
    rows = materialize(band_rows(docs, idf := word_idf(docs, text_col), id_col, text_col))
    copies = rows.groupBy("digest").agg(F.min("id").alias("copy_of"))
    found = materialize(rows.join(copies, "digest"))
    reps = found.filter("id = copy_of").select("id", "keys").dropDuplicates(["id"])
    classes = components(near_links(docs, reps, idf, id_col, text_col))
    named = found.select(F.col("id").alias("own"), "copy_of").join(
        classes.withColumnRenamed("id", "copy_of"), "copy_of", "left"
    )
    return named.select(
        F.col("own").alias(id_col), "copy_of", F.coalesce("class", "copy_of").alias("class_id")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that aren't the first of their class."""
    groups = near_groups(docs, id_col, text_col)
    dropped = groups.filter(col(id_col) != F.col("class_id")).select(id_col)
    return keep_ids(docs, materialize(dropped.distinct()), id_col)
