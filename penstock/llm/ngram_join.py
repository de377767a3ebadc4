"""Exact Jaccard join of n-gram sets by prefix trees.

Two sets of similarity t differ in few n-grams: at most d = (1 - t) / t of the
smaller one. The n-grams are dealt, by hash, into more than d parts, so near
sets agree on a whole part; documents that agree on a part, and only they, are
put into blocks. (A part with next to nothing in it says little: a document
with enough other parts leaves it out, and of a near pair one such document is
enough, because the two then agree on a part that both have.)

In a block the sets are stored in one trie, ordered by how many sets of the
block hold an n-gram, so that near sets share their way from the root. One
walk over the trie carries the overlap of the path so far with every set of the
block, shared by all sets below; a subtree is left as soon as the n-grams that
remain, in it and in the others, cannot bring any pair to the similarity.
The overlaps at the leaves are exact. Of the links of a block a spanning
forest comes out, which loses none as far as components are concerned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm import text_bytes
from penstock.llm.components import components
from penstock.llm.shingles import shingle_sets
from penstock.llm.store import prepared, written


@dataclass(frozen=True)
class Join:
    """Words per n-gram; least similarity in percent; sets and n-grams of a block, larger ones are compared in
    pairs of smaller blocks; n-grams from which on a part says enough; rows up to which a list of documents (of at most
    40 bytes each) is sent to every task, a longer one is joined by an exchange."""

    words: int = 3
    percent: int = 90
    sets: int = 1_024
    grams: int = 1 << 20
    telling: int = 3
    listed: int = 200_000

    def needed(self, left: np.ndarray | int, right: np.ndarray | int) -> np.ndarray | int:
        """Least common n-grams of linked sets of these sizes."""
        return -(-self.percent * (left + right) // (100 + self.percent))

    def differing(self, size: int) -> int:
        """Most n-grams in one but not both of linked sets, the smaller of ``size``."""
        return (100 - self.percent) * size // self.percent


# ---------------------------------------------------------------- parts of sets

def size_class(size: int) -> int:
    """Number of the half power of two at or below ``size``; near sets lie in the same class or the next."""
    return int(2 * np.log2(size) + 1e-9)


def class_parts(number: int, join: Join) -> int:
    """Parts of the sets compared in a class: more than the smaller of a pair can differ in, and some to spare.

    The smaller set of a pair decides the class."""
    most = join.differing(int(2 ** ((number + 1) / 2)) + 1)
    return most + 1 + (1 + most // 8 if most else 0)


def agreements(shingles: np.ndarray, join: Join) -> np.ndarray:
    """A 64-bit name for each part of a set (distinct hashes) that tells, in each class where it has partners."""
    size = len(shingles)
    least = -(-join.percent * size // 100)
    out = []
    for number in range(size_class(max(least, 1)), size_class(size) + 1):
        parts = class_parts(number, join)
        if parts == 1:
            continue  # equal sets only, and those are one already
        part = (text_bytes.mixed(shingles ^ np.uint64(0x51ED270B)) % np.uint64(parts)).astype(np.int64)
        held = np.bincount(part, minlength=parts)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, text_bytes.mixed(shingles))
        names = text_bytes.mixed(sums + text_bytes.mixed(
            np.arange(parts, dtype=np.uint64) + np.uint64(number << 32)))
        telling = held >= join.telling
        # without enough telling parts the others are given too
        spare = parts - int((~telling).sum()) > join.differing(min(size, int(2 ** ((number + 1) / 2)) + 1))
        out.append(names[telling] if spare else names)
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


SIGNED = "doc_id long, n_shingles long, h1 long, h2 long, parts array<long>"


def signed(docs: DataFrame, join: Join) -> DataFrame:
    """Size, 128-bit name and part names of each document's set; nulls for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, parts = [], [], [], []
            for shingles in text_bytes.shingle_sets(batch.column("text"), join.words):
                sizes.append(len(shingles))
                if len(shingles):
                    one.append(int(text_bytes.mixed(shingles).sum().astype(np.int64)))
                    two.append(int(text_bytes.mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().astype(np.int64)))
                    parts.append(agreements(shingles, join).view(np.int64))
                else:
                    one.append(None), two.append(None), parts.append(np.zeros(0, np.int64))
            offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "n_shingles", "h1", "h2", "parts"])

    return docs.mapInArrow(run, SIGNED)


# ---------------------------------------------------------------- the trie of a block

class _Forest:
    """Sets joined so far, by number."""

    def __init__(self, count: int) -> None:
        self.up = list(range(count))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def _shared_grams(flat: np.ndarray, owner: np.ndarray, sizes: np.ndarray, join: Join) -> tuple[np.ndarray, ...]:
    """Numbers of the n-grams held by several sets and their sets, for the sets that keep enough of them.

    A set with too few n-grams that any other holds has no partner; without it others may fall below."""
    gram = np.unique(flat, return_inverse=True)[1]
    least = join.needed(sizes, np.maximum(join.percent * sizes // 100, 1))
    while True:
        held = np.bincount(gram, minlength=1)
        kept = held[gram] > 1
        gram, owner = gram[kept], owner[kept]
        enough = np.bincount(owner, minlength=len(sizes)) >= least
        stay = enough[owner]
        if stay.all():
            return gram, owner
        gram, owner = gram[stay], owner[stay]


def linked(flat: np.ndarray, offsets: np.ndarray, side: np.ndarray, join: Join) -> list[tuple[int, int]]:
    """A spanning forest of the linked sets of a block, as pairs of set numbers.

    ``flat`` holds the sets' n-grams one set after the other, ``side`` 0 where a
    set is compared with all others, else 1 or 2 and it is compared with the other side.
    """
    sizes = np.diff(offsets)
    gram, owner = _shared_grams(flat, np.repeat(np.arange(len(sizes)), sizes), sizes, join)
    if not len(gram):
        return []
    # most frequent first, so that near sets have long ways in common
    held = np.bincount(gram)
    rank = np.empty(len(held), np.int64)
    rank[np.argsort(-held, kind="stable")] = np.arange(len(held))
    gram = rank[gram]
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    members, begin, count = np.unique(owner, return_index=True, return_counts=True)
    paths = [gram[b:b + c] for b, c in zip(begin.tolist(), count.tolist())]
    walk = sorted(range(len(paths)), key=lambda i: paths[i].astype(">u4").tobytes())
    paths, members = [paths[i] for i in walk], members[walk]
    place = np.empty(len(sizes), np.int64)
    place[members] = np.arange(len(members))
    order = np.lexsort((place[owner], gram))
    holders, first = place[owner][order], np.searchsorted(gram[order], np.arange(len(held) + 1))
    size, side = sizes[members], side[members]
    total = np.array([len(p) for p in paths])
    shared = [0] * (len(paths) + 1)  # with the path before
    for i in range(1, len(paths)):
        n = min(total[i - 1], total[i])
        apart = np.flatnonzero(paths[i - 1][:n] != paths[i][:n])
        shared[i] = int(apart[0]) if len(apart) else int(n)

    def below(start: int, depth: int) -> int:
        """The path after the last one that shares ``depth`` n-grams with path ``start``."""
        end = start + 1
        while end < len(paths) and shared[end] >= depth:
            end += 1
        return end

    def further(overlap: np.ndarray, path: np.ndarray) -> np.ndarray:
        lists = [holders[first[g]:first[g + 1]] for g in path.tolist()]
        return overlap + np.bincount(np.concatenate(lists), minlength=len(paths)) if lists else overlap

    def hopeless(overlap: np.ndarray, start: int, end: int, depth: int) -> bool:
        """No set can reach the similarity with one of the paths start..end-1, which share ``depth`` n-grams."""
        rest = np.minimum(total[start:end].max() - depth, total - overlap)
        open_ = overlap + rest >= join.needed(size, size[start:end].min())
        if end - start == 1:
            open_[start] = False
        return not open_.any()

    forest, found = _Forest(len(paths)), []
    stack = [(0, np.zeros(len(paths), np.int64))]
    i = 0
    while i < len(paths):
        while stack[-1][0] > shared[i]:
            stack.pop()
        depth, overlap = stack[-1]
        if depth < shared[i]:
            # the branching lies inside an edge that was walked at once
            overlap = further(overlap, paths[i][depth:shared[i]])
            depth = shared[i]
            stack.append((depth, overlap))
        branch = shared[i + 1]
        if branch > depth:
            overlap = further(overlap, paths[i][depth:branch])
            depth = branch
            end = below(i, depth)
            if hopeless(overlap, i, end, depth):
                i = end
                continue
            stack.append((depth, overlap))
        if not hopeless(overlap, i, i + 1, depth):
            overlap = further(overlap, paths[i][depth:])
            near = overlap >= join.needed(size, size[i])
            near &= (side != side[i]) | (side == 0)
            near[i] = False
            for j in np.flatnonzero(near).tolist():
                if forest.join(i, j):
                    found.append((int(members[i]), int(members[j])))
        i += 1
    return found


# ---------------------------------------------------------------- blocks

def by_block(members: DataFrame, work: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on the rows of each whole block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            block = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for first, last in zip(edges, edges[1:]):
                if first == last:
                    continue
                if rest and rest[0].column("block")[0].as_py() != block[first]:
                    yield work(pa.Table.from_batches(rest))
                    rest = []
                rest.append(batch.slice(first, last - first))
        if rest:
            yield work(pa.Table.from_batches(rest))

    return members.repartition("block").sortWithinPartitions("block", "doc").mapInArrow(run, schema)


def links(members: DataFrame, join: Join) -> DataFrame:
    """Links (a, b) found in the blocks of ``members(block, doc, side, shingles)``."""
    def pairs(table: pa.Table) -> pa.RecordBatch:
        doc, side = table.column("doc").to_numpy(), table.column("side").to_numpy()
        lists = table.column("shingles").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        found = linked(lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)]), side, join)
        ends = doc[np.array(found, np.int64).reshape(-1, 2)]
        return pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1, initial=2**63 - 1)), pa.array(ends.max(
            axis=1, initial=-2**63))], names=["a", "b"])

    return by_block(members, pairs, "a long, b long").distinct()


def blocks(agreed: DataFrame, join: Join) -> DataFrame:
    """(block, doc, side) from ``agreed(part, doc, size)``: every two documents that agree on a part share a block.

    A group of documents that agree, directly or through others, is one block if it is small enough. In
    larger ones each part's documents are a block, one for parts with the same documents; what is still
    too large becomes pairs of smaller blocks, so that no task holds more than a block.
    """
    several = agreed.groupBy("part").count().where("count > 1").select("part")
    # the same plan at every size: the parts that several sets have grow with the table
    found = written(agreed.join(several.hint("merge"), "part"), "shared-parts")
    counted = found.groupBy("part").agg(
        F.count("*").alias("n"), F.sum("size").alias("grams"), F.min("doc").alias("hub"),
        F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("name"))
    kept = counted.groupBy("n", "grams", "hub", "name").agg(F.min("part").alias("part")).drop("name")
    rows = written(found.join(kept, "part").select("part", "doc", "size", "hub", "n", "grams"), "agreed")
    ends = components(rows.where("doc <> hub").select(F.col("doc").alias("a"), F.col("hub").alias("b"))) \
        .select(F.col("node").alias("doc"), F.col("component").alias("group"))
    placed = written(rows.select("doc", "size").distinct().join(ends, "doc"), "groups-of-parts")
    small = written(placed.groupBy("group").agg(F.count("*").alias("members"), F.sum("size").alias("held"))
                    .where((F.col("members") <= join.sets) & (F.col("held") <= join.grams)).select("group"), "small")
    whole = placed.join(small, "group").select(F.xxhash64(F.lit(0), "group").alias("block"), "doc",
                                               F.lit(0).alias("side"))
    wide = rows.join(placed.join(small, "group", "left_anti").select("doc"), "doc", "left_semi")
    apart = F.ceil(F.greatest(2 * F.col("n") / join.sets, 2 * F.col("grams") / join.grams)).cast("int")
    fits = (F.col("n") <= join.sets) & (F.col("grams") <= join.grams)
    dealt = wide.withColumn("pieces", F.when(fits, 1).otherwise(apart)).withColumn(
        "piece", F.pmod(F.xxhash64("doc"), F.col("pieces")).cast("int"))
    paired = dealt.select("part", "doc", "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
    split = paired.select(
        F.xxhash64("part", F.least("piece", "other"), F.greatest("piece", "other")).alias("block"), "doc",
        F.when(F.col("piece") == F.col("other"), 0).when(F.col("piece") < F.col("other"), 1).otherwise(2).alias("side"))
    return whole.unionByName(split)


# ---------------------------------------------------------------- the operator

def ngram_join(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text",
               **bounds: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, the set holds the distinct windows of ``words`` words (a
    shorter text is one window). Two documents link when the intersection is at least ``percent`` percent of the
    union; component_id is the smallest id that links reach. ``bounds`` are fields of ``Join``.

    A null or empty text, or one without words, has an empty set and is its own component. A null id takes no part and
    keeps a null component. Rows that repeat an id share its component. Equal sets are one set for the join. Other
    columns of ``docs``, of whatever names, play no role. An empty table gives no rows.
    """
    prepared(docs.sparkSession)
    join = Join(words=words, percent=percent, **bounds)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    base = written(signed(docs, join), "ngram-sets")
    name = ["n_shingles", "h1", "h2"]
    usable = base.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = written(usable.groupBy(*name).agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
                     .where("n > 1").drop("n"), "ngram-copies")
    known = F.broadcast(copies) if copies.count() <= join.listed else copies
    named = usable.join(known, name, "left").where("first IS NULL OR first = doc_id")
    agreed = written(named.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("size"),
                                  F.explode("parts").alias("part")), "parts-of-sets")
    members = written(blocks(agreed, join), "blocks")
    ids = written(members.select(F.col("doc").alias("doc_id")).distinct(), "joined-ids")
    few = ids.count() <= join.listed
    sets = shingle_sets(docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi"), join.words) \
        .select(F.col("doc_id").alias("doc"), "shingles")
    # an id may name several rows with different texts: each is a set of its own under that id
    found = written(links(members.join(sets, "doc"), join), "ngram-links")
    groups = components(found).select(F.col("node").alias("first"), "component")
    ends = base.select("doc_id", *name).join(known, name, "left").withColumn("first", F.coalesce("first", "doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first"))
    return ends.join(groups, "first", "left").select("doc_id", "n_shingles", component.alias("component_id"))
