"""Exact Jaccard join of word n-gram sets with count vectors in packed R-trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import lookup_join, materialize, salted_join
from .common import col, kept
from .components import components
from .words import distinct_words, mix, slices

WORDS = 3
# Two sets are linked when DEN * shared >= NUM * union.
NUM, DEN = 90, 100
# Texts with a shingle of the same hash bucket, for an order of shingles, rare ones first.
BUCKETS = 1 << 18
BLOCK = 400
# Sets have 2**4 to 2**16 groups.
GROUP_BITS = 4, 16
SALTS = 64
CELL = ["key", "band", "low", "high"]
LEAF, FAN = 16, 16
KNOWN_WORDS = 400_000
# Whole passes over the texts take so many bytes at once: the more, the fewer distinct words.
TEXT_BYTES = 4 << 20


class WordNumbers:
    """A 64-bit number for every word, by a cryptographic hash; the latest words are remembered."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known = self.known
        for word in set(words) - known.keys():
            known[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, by their 64-bit numbers, and where each text's begin.

    A shingle is three words in a row; a text of one or two words is one shingle.
    """
    at_word, counts, words = distinct_words(texts)
    number = kept("word numbers", WordNumbers).of(words.to_pylist())[at_word]
    text = np.repeat(np.arange(len(counts)), counts)
    last = max(len(number) - WORDS + 1, 0)
    at = np.flatnonzero(text[:last] == text[len(text) - last:])
    shingle = np.zeros(len(at), np.uint64)
    for j in range(WORDS):
        shingle = mix(shingle + number[at + j])
    text = text[at]
    begins = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        # Another start than that of whole shingles.
        more = mix(np.uint64(1) + number[begins[short]])
        two = counts[short] == 2
        more[two] = mix(more[two] + number[begins[short][two] + 1])
        shingle, text = np.append(shingle, more), np.append(text, short)
        order = np.argsort(text, kind="stable")
        shingle, text = shingle[order], text[order]
    bounds = np.searchsorted(text, np.arange(len(counts) + 1)).tolist()
    for a, b in zip(bounds, bounds[1:]):
        shingle[a:b].sort()
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    return shingle[new], np.searchsorted(text[new], np.arange(len(counts) + 1))


def bucket_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """How many texts have a shingle of each bucket, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0), TEXT_BYTES):
                shingle, _ = shingle_sets(batch.column(0).slice(a, b - a))
                counts += np.bincount((shingle % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    counted = docs.select(col(text_col)).mapInArrow(count, "bucket long, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return counts


def prefixes(shingle: np.ndarray, begins: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of each set, so many that linked sets share one of them.

    Linked sets share at least NUM / DEN of either, so what is left of a set after all but
    that many is taken cannot hold all they share.  Any order of shingles serves, if it
    is the same for all sets.
    """
    sizes = np.diff(begins)
    rank = common[(shingle % np.uint64(BUCKETS)).astype(np.int64)]
    wanted = np.where(sizes > 0, sizes + 1 - -(-NUM * sizes // DEN), 0)
    # The shingles of a set are in order, so those of the same rank stay in it.
    chosen = [
        a + np.argsort(rank[a:b], kind="stable")[:n]
        for a, b, n in zip(begins[:-1].tolist(), begins[1:].tolist(), wanted.tolist())
    ]
    keys = shingle[np.concatenate(chosen)] if chosen else shingle[:0]
    return keys, np.append(0, np.cumsum(wanted))


def set_rows(docs: DataFrame, common: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``id, n, digest, keys, counts`` of every text's set; the digest of an empty one is null."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), TEXT_BYTES):
                part = batch.slice(a, b - a)
                shingle, begins = shingle_sets(part.column(1))
                keys, ends = prefixes(shingle, begins, shared.value)
                sets = [shingle[s:e].tobytes() for s, e in zip(begins, begins[1:])]
                digests = [hashlib.blake2b(s, digest_size=16).digest() if s else None for s in sets]
                counts = count_vectors(shingle, begins, groups_for(np.diff(begins)))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(begins)), pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.view(np.int64))),
                    pa.array(counts, pa.binary()),
                ], ["id", "n", "digest", "keys", "counts"])

    return docs.select(col(id_col), col(text_col)).mapInArrow(
        run, f"id {kind}, n long, digest binary, keys array<bigint>, counts binary"
    )


def groups_for(sizes: np.ndarray) -> np.ndarray:
    """Powers of two, so that a group of a set has about eight shingles."""
    wanted = np.ceil(np.log2(np.maximum(sizes, 1) / 8)).astype(np.int64)
    return 1 << np.clip(wanted, *GROUP_BITS)


def count_vectors(shingle: np.ndarray, begins: np.ndarray, groups: np.ndarray) -> list[bytes]:
    """How many shingles of each set fall into each of its groups of hashes, 16 bits each."""
    ends = np.cumsum(groups)
    text = np.repeat(np.arange(len(groups)), np.diff(begins))
    cell = (ends - groups)[text] + ((shingle >> np.uint64(40)).astype(np.int64) & (groups[text] - 1))
    counts = np.bincount(cell, minlength=int(ends[-1]) if len(ends) else 0)
    # A greater count than fits would need half a billion shingles.
    data = np.minimum(counts, 0xFFFF).astype("<u2").tobytes()
    return [data[2 * (e - g):2 * e] for e, g in zip(ends.tolist(), groups.tolist())]


def alike(vectors: list[bytes], groups: int) -> np.ndarray:
    """Vectors as rows of ``groups`` counts, those of more groups added up."""
    out = np.zeros((len(vectors), groups), np.int32)
    for k, data in enumerate(vectors):
        out[k] = np.frombuffer(data, "<u2").reshape(-1, groups).sum(axis=0)
    return out


def may_link(shared: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether sets may be linked that share at most ``shared``."""
    return DEN * shared >= NUM * (sizes + others - shared)


class CountTree:
    """A packed R-tree over the count vectors of sets.

    Points are sorted by size, and tile by tile by the coordinates that vary most; so many
    in a row are a leaf, so many leaves a node.  A box keeps the greatest counts and
    the least size of what is below it.  Sets share no more than the summed minima of
    their counts, and a set shares no more with any set in a box than the summed minima of
    its counts and the box's greatest.
    """

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray) -> None:
        self.order = self.tiled(vectors, sizes)
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        self.levels = [(self.vectors, self.sizes)]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            high, low = self.levels[-1]
            starts = np.arange(0, len(low), width)
            self.levels.append((np.maximum.reduceat(high, starts), np.minimum.reduceat(low, starts)))
            width = FAN
        self.all = np.arange(len(sizes))

    def tiled(self, vectors: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        order = np.argsort(sizes, kind="stable")
        if len(order) <= LEAF:
            return order
        slab = max(LEAF, int(np.ceil(len(order) ** 0.5)))
        first, second = np.argsort(-vectors.var(axis=0), kind="stable")[:2]
        parts = []
        for at in range(0, len(order), slab):
            part = order[at:at + slab]
            parts.append(part[np.lexsort((vectors[part, second], vectors[part, first]))])
        return np.concatenate(parts)

    def candidates(self, vector: np.ndarray, size: int) -> np.ndarray:
        """Points that may be linked with a set, by descending through boxes that may hold one."""
        at = np.arange(len(self.levels[-1][1]))
        for level in range(len(self.levels) - 1, -1, -1):
            high, low = self.levels[level]
            most = np.minimum(high[at], vector).sum(axis=1)
            # What is shared is at most `most`, so the union is at least the rest of both.
            at = at[may_link(most, size, low[at])]
            if level:
                width = LEAF if level == 1 else FAN
                below = len(self.levels[level - 1][1])
                at = (at[:, None] * width + np.arange(width)).ravel()
                at = at[at < below]
        return self.order[at]


def links_within(
    texts: pa.Array, ids: list, classes: list, blocks: np.ndarray, visits: np.ndarray
) -> list[tuple]:
    """Links between texts of a cell that join all classes its linked pairs connect.

    Pairs of two visitors of the band are decided in their own band, and where two blocks
    meet, pairs of one block in a cell of its own.  Pairs connected by then are left out.
    """
    shingle, begins = shingle_sets(texts)
    sizes = np.diff(begins)
    groups = groups_for(sizes)
    vectors = alike(count_vectors(shingle, begins, groups), int(groups.min(initial=1 << GROUP_BITS[1])))
    tree = CountTree(vectors, sizes)
    names = {c: k for k, c in enumerate(dict.fromkeys(classes))}
    group = np.array([names[c] for c in classes], np.int64)
    # The most usual come first: the original of many edited copies joins most of them.
    middle = np.median(vectors, axis=0)
    done = sizes == 0
    both = len(np.unique(blocks)) > 1
    found = []
    for i in np.argsort(np.abs(vectors - middle).sum(axis=1), kind="stable"):
        done[i] = True
        if not sizes[i]:
            continue
        near = tree.candidates(vectors[i], sizes[i])
        here = ~(visits[near] & visits[i])
        if both:
            here &= blocks[near] != blocks[i]
        near = near[here & ~done[near] & (group[near] != group[i])]
        if not len(near):
            continue
        shared = shared_counts(shingle, begins, i, near)
        for j in near[may_link(shared, sizes[i], sizes[near])]:
            if group[j] != group[i]:
                found.append((ids[i], ids[j]))
                group[group == group[j]] = group[i]
    return found


def shared_counts(shingle: np.ndarray, begins: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """How many shingles one set shares with each of some others."""
    own = shingle[begins[i]:begins[i + 1]]
    counts = begins[others + 1] - begins[others]
    starts = np.cumsum(counts) - counts
    theirs = shingle[np.arange(counts.sum()) + np.repeat(begins[others] - starts, counts)]
    at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
    return np.add.reduceat((own[at] == theirs).astype(np.int64), starts)


def possible_pairs(pairs: DataFrame) -> DataFrame:
    """Those of ``leader, id, n, counts, m, leader_counts`` whose vectors allow a link."""
    kind = pairs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            of = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            groups = np.array([min(len(x), len(y)) // 2 for x, y in zip(*of)], np.int64)
            good = np.zeros(len(n), bool)
            for g in np.unique(groups):
                for at in np.array_split(np.flatnonzero(groups == g), max(1, int(g * len(n) >> 22))):
                    both = [alike([x[k] for k in at], int(g)) for x in of]
                    good[at] = may_link(np.minimum(*both).sum(axis=1), n[at], m[at])
            chosen = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], ["leader", "id"])

    chosen = pairs.select("leader", "id", "n", "counts", "m", "leader_counts")
    return chosen.mapInArrow(run, f"leader {kind}, id {kind}")


def possible_members(cells: DataFrame) -> DataFrame:
    """Rows of ``cells`` that some row of another class in the cell may be linked with.

    Cells pass by whole, in order; their members' vectors are searched in a tree.
    """
    names = [*CELL, "block", "visit", "id", "class", "n", "counts"]
    schema = cells.select(names[:-2]).schema

    def keep(rows: pa.Table) -> pa.Table:
        key = np.stack([rows[c].to_numpy() for c in CELL])
        first = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
        sizes, block = rows["n"].to_numpy(), rows["block"].to_numpy()
        visit = rows["visit"].to_numpy() == 1
        class_ = np.unique(rows["class"].to_numpy(), return_inverse=True)[1]
        counts = rows["counts"].to_pylist()
        good = np.zeros(rows.num_rows, bool)
        for s, e in zip(first, [*first[1:], rows.num_rows]):
            if e - s < 2 or (class_[s:e] == class_[s]).all():
                continue
            vectors = alike(counts[s:e], min(map(len, counts[s:e])) // 2)
            tree, both = CountTree(vectors, sizes[s:e]), block[s:e].min() != block[s:e].max()
            for i in range(e - s):
                near = tree.candidates(vectors[i], sizes[s + i]) + s
                near = near[(class_[near] != class_[s + i]) & ~(visit[near] & visit[s + i])]
                if both:
                    near = near[block[near] != block[s + i]]
                good[near] = True
        return rows.select(names[:-2]).filter(pa.array(good))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last cell of a batch may go on in the next one.
            key = np.stack([batch.column(c).to_numpy() for c in CELL])
            cut = np.flatnonzero((key != key[:, -1:]).any(axis=0))
            cut = int(cut[-1]) + 1 if len(cut) else 0
            if held and (cut or [held[-1].column(c)[-1] for c in CELL] != [batch.column(c)[0] for c in CELL]):
                whole = pa.Table.from_batches([*held, batch.slice(0, cut)])
                yield from keep(whole.combine_chunks()).to_batches()
                held = []
            elif cut:
                yield from keep(pa.Table.from_batches([batch.slice(0, cut)])).to_batches()
            held.append(batch.slice(cut))
        if held:
            yield from keep(pa.Table.from_batches(held).combine_chunks()).to_batches()

    dealt = cells.select(names).repartition(*CELL).sortWithinPartitions(*CELL)
    return dealt.mapInArrow(run, schema)


def links_to_leaders(rows: DataFrame) -> DataFrame:
    """Links ``a, b`` of leaders to members of their blocks.

    ``rows`` has ``leader, block, id, text``; the leader's own row comes first in a block.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            for a, b in slices(batch.column(3)):
                part = batch.slice(a, b - a)
                shingle, begins = shingle_sets(part.column(3))
                sizes = np.diff(begins)
                found = []
                for k, (of, one) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist())):
                    mine = shingle[begins[k]:begins[k + 1]]
                    if of == one:
                        leader, own = one, mine.copy()
                    elif of == leader and len(own) and len(mine):
                        at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                        shared = int((own[at] == mine).sum())
                        if may_link(shared, len(own), sizes[k]):
                            found.append((of, one))
                if found:
                    cells = [pa.array(c, part.schema.field(2).type) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(cells, ["a", "b"])

    order = [F.col("leader"), F.col("block"), F.col("id") != F.col("leader"), F.col("id")]
    dealt = rows.repartition("leader", "block").sortWithinPartitions(*order)
    return dealt.select("leader", "block", "id", "text").mapInArrow(verify, f"a {kind}, b {kind}")


def size_band(n: Column) -> Column:
    """Sizes of linked sets are in the same band or in neighbouring ones."""
    return F.floor(F.ln(n.cast("double")) / float(np.log(DEN / NUM)) + 1e-9).cast("int")


def cells_of(members: DataFrame) -> DataFrame:
    """Rows ``key, band, low, high, block, visit, id, class, n`` of cells that decide all pairs of a key.

    A key with few members is one cell.  The members of others are dealt by the size of
    their sets, each to its band and as a visitor to the next, and a band of many members
    by blocks, each two of which meet in a cell.
    """
    several = members.groupBy("key").agg(
        F.min("class").alias("least"), F.max("class").alias("most"), F.count(F.lit(1)).alias("of")
    ).filter("least <> most").select("key", "of")
    rest = lookup_join(members.drop("of"), materialize(several), ["key"], "inner")
    large = F.col("of") > BLOCK
    band = F.when(large, size_band(F.col("n"))).otherwise(0)
    visits = F.when(large, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = rest.select("key", "id", "class", "n", band.alias("own"), F.explode(visits).alias("visit"))
    placed = placed.withColumn("band", F.col("own") + F.col("visit")).drop("own")
    blocks = placed.groupBy("key", "band").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count_if(F.col("visit") == 0).alias("owned")
    ).filter("owned > 0").drop("owned")
    placed = lookup_join(placed, materialize(blocks), ["key", "band"], "inner").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    # Blocks meet in pairs; within a block its members meet in the cell of the block alone.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.select(
        "key", "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "visit", "id", "class", "n",
    )


def near_links(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Links ``a, b`` that have the components of all linked pairs of ``reps``."""
    kind = reps.schema["id"].dataType.simpleString()
    # Shingles with an octave of sizes; sets near its upper end also stand in the next one.
    octave = F.floor(F.log2(F.col("n").cast("double")) + 1e-9)
    above = F.floor(F.log2(F.col("n") * (DEN / NUM)) + 1e-9)
    keys = reps.select("id", "n", F.explode(F.array_distinct(F.array(octave, above))).alias("octave"), "keys")
    keys = keys.select("id", "n", "octave", F.explode("keys").alias("key"))
    keys = keys.select("id", "n", F.xxhash64("octave", "key").alias("key"))
    sizes = keys.groupBy("key").agg(
        F.min("id").alias("leader"), F.min_by("n", "id").alias("m"), F.count(F.lit(1)).alias("of"),
        # Keys of the same sets are known by this and taken once.
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("mark"),
    ).filter("of > 1")
    sizes = materialize(
        sizes.groupBy("leader", "m", "of", "mark").agg(F.min("key").alias("key")).drop("mark")
    )
    total = keys.count()
    # Fewer than SALTS keys can hold so large a share.
    hot = sizes.filter(F.col("of") * SALTS > total).select("key").collect()
    members = materialize(
        salted_join(keys, sizes, ["key"], "inner", SALTS, hot) if hot else keys.join(sizes, "key")
    )
    # The ids grow with the corpus, so they are merged with texts and vectors at every size.
    met = members.select("id").distinct()
    vectors = materialize(reps.select("id", "counts").join(met.hint("merge"), "id", "left_semi"))
    texts = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    texts = materialize(texts.join(met.hint("merge"), "id", "left_semi"))

    fits = F.least("n", "m") * DEN >= F.greatest("n", "m") * NUM
    pairs = members.filter("id <> leader").filter(fits).select("leader", "id", "n", "m").distinct()
    of_leader = vectors.withColumnsRenamed({"id": "leader", "counts": "leader_counts"})
    leaders = pairs.select("leader").distinct()
    of_leader = materialize(of_leader.join(leaders.hint("merge"), "leader", "left_semi"))
    pairs = lookup_join(pairs.join(vectors.hint("merge"), "id"), of_leader, ["leader"], "inner")
    pairs = materialize(possible_pairs(pairs).distinct())
    blocks = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = lookup_join(pairs, blocks, ["leader"], "inner").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    heads = blocks.select("leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    placed = placed.select("leader", "block", "id").unionByName(heads.withColumn("id", F.col("leader")))
    first = materialize(links_to_leaders(placed.join(texts, "id")).distinct())

    classes = components(first)
    rest = members.filter("of > 2 AND id <> leader").select("key", "id", "n", "of")
    rest = lookup_join(rest, classes, ["id"]).withColumn("class", F.coalesce("class", "id"))

    def decide(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("id")
        text = group["text"].chunk(0) if group.num_rows else pa.array([], pa.string())
        found = links_within(
            text, group["id"].to_pylist(), group["class"].to_pylist(), group["block"].to_numpy(),
            group["visit"].to_numpy() == 1,
        )
        return pa.table({k: pa.array([f[i] for f in found], group.schema.field("id").type) for i, k in enumerate("ab")})

    cells = materialize(possible_members(cells_of(rest).join(vectors.hint("merge"), "id")))
    # Many keys leave the same rows; these are decided once.
    marks = cells.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("of"),
        F.sum(F.xxhash64("id", "block", "visit").cast("decimal(38,0)")).alias("mark"),
    )
    once = marks.groupBy("of", "mark").agg(F.min(F.struct(*CELL)).alias("one")).select("one.*")
    cells = lookup_join(cells, materialize(once), CELL, "left_semi")
    second = cells.join(texts.hint("merge"), "id").groupBy(*CELL).applyInArrow(decide, f"a {kind}, b {kind}")
    return first.unionAll(materialize(second.distinct()))


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``.

    Texts are sets of shingles of three words, A-Z lowered; two are linked when their
    Jaccard similarity is 0.9 or more, and ``component_id`` is the least id reachable by
    links.  No pair is lost: linked sets share one of the rarest tenth of their shingles,
    so these bring sets together, and among those that meet, count vectors in an R-tree
    leave out what cannot share enough; the others are compared shingle by shingle.

    Words are numbered by 64 bits of a cryptographic hash and shingles mixed from these;
    equal sets are known by 128 bits.

    Nulls: a null text is empty, an empty set is linked with nothing and its component is
    its own id; a row without an id has the component of its text, null if no equal set has
    an id.  A row is known by its id, so rows of one id are one document.  Ties do not
    arise, every choice is by least id.  No rows give no rows.
    """
    rows = materialize(set_rows(docs, bucket_counts(docs, text_col), id_col, text_col))
    copies = rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("copy_of"), F.count(F.lit(1)).alias("times")
    ).filter("times > 1").drop("times")
    # Equal sets are taken once; a digest of very many rows is salted.
    found = materialize(lookup_join(rows, copies, ["digest"]).withColumn("copy_of", F.coalesce("copy_of", "id")))
    reps = found.filter("id = copy_of AND n > 0").select("id", "n", "keys", "counts", "digest")
    reps = reps.dropDuplicates(["id", "digest"]).drop("digest")
    links = near_links(docs, reps, id_col, text_col)
    # Rows of one id that have several texts connect these.
    several = materialize(
        found.filter("id IS NOT NULL").groupBy("id").agg(F.min("copy_of").alias("a"), F.max("copy_of").alias("b"))
        .filter("a < b").select("id")
    )
    if not several.isEmpty():
        again = lookup_join(found.select("id", "copy_of"), several, ["id"], "left_semi")
        links = links.unionAll(again.toDF("a", "b"))
    classes = components(links)
    named = lookup_join(
        found.select(F.col("id").alias("own"), "n", "copy_of"), classes.withColumnRenamed("id", "copy_of"), ["copy_of"]
    )
    return named.select(
        F.col("own").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("class", "copy_of").alias("component_id"),
    )
