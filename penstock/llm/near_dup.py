"""Near-duplicate groups by a chosen-path similarity join.

Every text is a set of word shingles. A tree sends the sets into nodes by the
minimum of one hash function over their shingles, splits nodes that are too
large by the minimum of a further function, and so on; two sets stay together
with the probability of their Jaccard similarity at each step. Small nodes are
compared exhaustively. Independent trees are repeated until the chance that a
pair is never in one small node is negligible. Where nodes went on so deep that
the trees do not suffice, as in a family of documents around one boilerplate,
the documents concerned are also joined by the rarest of their shingles: two
near sets have one in common there, for certain, whatever the depth.

Equal sets are first put under the smallest id. In a node only the links of a
maximal spanning forest (by the similarity of 128-byte sketches) are kept, for
a group of m near copies m - 1 instead of all pairs; they are confirmed on the
full sets. A second pass looks at the nodes that still hold near documents of
different groups and confirms, within the node, every near pair between groups
that no link has joined by then, so a forest link that failed hides no other.
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

FUNCTIONS = 128
#: Functions by which a node is split at once where the trees don't suffice.
FASTER = 4
_ODD = np.random.default_rng(7).integers(0, 2**32, FUNCTIONS, dtype=np.uint32) | np.uint32(1)
_SALT = np.random.default_rng(8).integers(0, 2**32, FUNCTIONS, dtype=np.uint32)


@dataclass(frozen=True)
class Plan:
    """Words per shingle; least similarity in percent; trees; sets compared at once; depth before
    a node is compared in blocks; chance of missing a pair beyond which a document is also joined by its rare
    shingles; rows up to which a list of documents (of at most 40 bytes each) is sent to
    every task, a longer one is joined by an exchange."""

    words: int = 5
    percent: int = 80
    trees: int = 20
    node: int = 1_024
    depth: int = 24
    missed: float = 3e-5
    listed: int = 200_000

    def coordinate(self, level: int) -> list[int]:
        """The hash function of each tree at a level; distinct over trees and the first levels."""
        return [(tree + level * self.trees + (level * self.trees // FUNCTIONS) * 7) % FUNCTIONS
                for tree in range(self.trees)]

    def safe_levels(self) -> int:
        """Functions by which every tree may split before a pair at the least similarity is missed too often."""
        level = 0
        while (1 - (self.percent / 100) ** (level + 1)) ** self.trees <= self.missed and level < self.depth:
            level += 1
        return level

    def least_matches(self) -> int:
        """Equal sketch bytes that a pair at the least similarity falls short of about once in a million times."""
        share = self.percent / 100
        return int(FUNCTIONS * share - 5 * (FUNCTIONS * share * (1 - share)) ** 0.5)


# ---------------------------------------------------------------- texts to sets

def _minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(FUNCTIONS, 0xFFFFFFFF, dtype=np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 4096):
        part = short[None, at:at + 4096] ^ _SALT[:, None]
        part *= _ODD[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


SIGNED = "doc_id long, n_shingles long, h1 long, h2 long, minima binary, sketch binary"


def signed(docs: DataFrame, words: int) -> DataFrame:
    """Size, 128-bit name, minima and sketch of each document's set; nulls for an empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                        ("minima", pa.binary()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for shingles in text_bytes.shingle_sets(batch.column("text"), words):
                if len(shingles):
                    least = _minima(shingles)
                    names = [int(x.sum().astype(np.int64)) for x in (
                        text_bytes.mixed(shingles), text_bytes.mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)))]
                    rows.append((len(shingles), *names, least.tobytes(), (least >> np.uint32(13)).astype(np.uint8)
                                 .tobytes()))
                else:
                    rows.append((0, None, None, None, None))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))],
                schema=schema)

    return docs.mapInArrow(run, SIGNED)


# ---------------------------------------------------------------- nodes to pairs

def _close_pairs(node: np.ndarray, doc: np.ndarray, size: np.ndarray, group: np.ndarray | None, sketch: np.ndarray,
                 side: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of the pairs within a node whose sketches and sizes allow the similarity, and their matches."""
    left, right, found = [], [], []
    rows = np.arange(len(node))
    shift = 1
    while True:
        rows = rows[rows + shift < len(node)]
        rows = rows[node[rows] == node[rows + shift]]
        if not len(rows):
            break
        other = rows + shift
        small, big = np.minimum(size[rows], size[other]), np.maximum(size[rows], size[other])
        wanted = (doc[rows] != doc[other]) & (100 * small >= plan.percent * big) & ((side[rows] != side[other])
                                                                                   | (side[rows] == 0))
        if group is not None:
            wanted &= group[rows] != group[other]
        i, j = rows[wanted], other[wanted]
        equal = (sketch[i] == sketch[j]).sum(axis=1)
        near = equal >= plan.least_matches()
        left.append(i[near]), right.append(j[near]), found.append(equal[near])
        shift += 1
    if not left:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(left), np.concatenate(right), np.concatenate(found)


def _forest(node: np.ndarray, left: np.ndarray, right: np.ndarray, matches: np.ndarray, doc: np.ndarray) -> list[int]:
    """Numbers of the pairs that form a maximal spanning forest of each node; ties go to smaller ids, alike in
    every tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    kept: list[int] = []
    order = np.lexsort((np.maximum(doc[left], doc[right]), np.minimum(doc[left], doc[right]), -matches, node[left]))
    edges = np.append(np.flatnonzero(np.diff(node[left[order]], prepend=node[left[order[0]]] - 1)), len(order))
    for first, last in zip(edges.tolist(), edges[1:].tolist()):
        here = order[first:last]
        wanted = len(np.unique(np.concatenate([left[here], right[here]]))) - 1  # one tree, at most
        for k, x, y in zip(here.tolist(), left[here].tolist(), right[here].tolist()):
            a, b = root(x), root(y)
            if a != b:
                parent[a] = b
                kept.append(k)
                wanted -= 1
                if not wanted:
                    break
    return kept


def _by_node(members: DataFrame, work: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on the rows of whole nodes, as many at a time as a batch holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            node = table.column("node").to_numpy()
            cut = int(np.searchsorted(node, node[-1], side="left"))  # the last node may go on in the next batch
            rest = table.slice(cut)
            if cut:
                yield work(table.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield work(rest)

    return members.repartition("node").sortWithinPartitions("node", "doc").mapInArrow(run, schema)


def _columns(table: pa.Table) -> tuple[np.ndarray, ...]:
    node, doc, size, side, group = (table.column(c).to_numpy() for c in ("node", "doc", "size", "side", "component"))
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, FUNCTIONS)
    return node, doc, size, side, group, sketch


def candidate_pairs(members: DataFrame, plan: Plan) -> DataFrame:
    """The spanning forest (a, b) of near pairs of each node of ``members(node, doc, size, sketch, side)``."""
    def pairs(table: pa.Table) -> pa.RecordBatch:
        node, doc, size, side, _, sketch = _columns(table)
        left, right, matches = _close_pairs(node, doc, size, None, sketch, side, plan)
        if len(left):
            kept = np.array(_forest(node, left, right, matches, doc))
            left, right = left[kept], right[kept]
        ends = np.unique(np.stack([np.minimum(doc[left], doc[right]), np.maximum(doc[left], doc[right])]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1])], names=["a", "b"])

    return _by_node(members.withColumn("component", F.col("doc")), pairs, "a long, b long")


def still_near(members: DataFrame, plan: Plan) -> DataFrame:
    """The rows of ``members`` that have a near pair in their node of another component."""
    columns = ["node", "doc", "size", "side", "component", "sketch"]

    def rows(table: pa.Table) -> pa.RecordBatch:
        node, doc, size, side, group, sketch = _columns(table)
        left, right, _ = _close_pairs(node, doc, size, group, sketch, side, plan)
        kept = np.unique(np.concatenate([left, right]))
        return pa.RecordBatch.from_arrays([table.column(c).take(kept).combine_chunks() for c in columns], names=columns)

    return _by_node(members, rows, "node long, doc long, size long, side int, component long, sketch binary")


def _common(values: np.ndarray, offsets: np.ndarray, left: np.ndarray, right: np.ndarray,
            wanted: Callable[[int, int], bool]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, the j of the pairs (i, j) still wanted, their common shingles), one i after the other.

    A set meets all its partners at once, by lists of the sets that hold a shingle.
    """
    rows = np.unique(np.concatenate([left, right]))
    flat = np.concatenate([values[offsets[r]:offsets[r + 1]] for r in rows])
    lengths = offsets[rows + 1] - offsets[rows]
    owner = np.repeat(np.arange(len(rows)), lengths)
    gram = np.unique(flat, return_inverse=True)[1]
    order = np.argsort(gram, kind="stable")
    holders, first = owner[order], np.searchsorted(gram[order], np.arange(gram.max(initial=0) + 2))
    begin = np.concatenate([[0], np.cumsum(lengths)])
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    edges = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1], [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        i, others = int(left[a]), right[a:b]
        others = others[np.fromiter((wanted(i, int(j)) for j in others), bool, len(others))]
        if len(others):
            at = int(np.searchsorted(rows, i))
            mine = gram[begin[at]:begin[at + 1]]
            met = np.bincount(np.concatenate([holders[first[g]:first[g + 1]] for g in mine.tolist()]),
                              minlength=len(rows))
            yield i, others, met[np.searchsorted(rows, others)]


def confirmed_within(members: DataFrame, plan: Plan) -> DataFrame:
    """Links (a, b) that join components, from ``members(..., component, shingles)``: every near pair of different
    components of a node is confirmed on the full sets, until a link has joined the two."""
    def links(table: pa.Table) -> pa.RecordBatch:
        node, doc, size, side, group, sketch = _columns(table)
        left, right, matches = _close_pairs(node, doc, size, group, sketch, side, plan)
        lists = table.column("shingles").combine_chunks()
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (above := up.get(x, x)) != x:
                up[x] = x = up.get(above, above)
            return x

        found: list[tuple[int, int]] = []
        order = np.argsort(node[left], kind="stable")
        left, right = left[order], right[order]
        edges = np.flatnonzero(np.concatenate([[True], node[left][1:] != node[left][:-1], [True]])) if len(left) else []
        for first, last in zip(edges[:-1], edges[1:]):
            for i, others, common in _common(values, offsets, left[first:last], right[first:last], lambda i, j: root(
                    int(group[i])) != root(int(group[j]))):
                sizes = size[i] + size[others]
                for j in others[100 * common >= plan.percent * (sizes - common)].tolist():
                    p, q = root(int(group[i])), root(int(group[j]))
                    if p != q:
                        up[p] = q
                        found.append((int(doc[i]), int(doc[j])))
        ends = list(zip(*found)) or [[], []]
        return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], names=["a", "b"])

    return _by_node(members, links, "a long, b long")


def alike(pairs: DataFrame, sketches: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) whose sketches and sizes allow the similarity."""
    def near(a: pa.Array, b: pa.Array) -> pa.Array:
        left, right = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, FUNCTIONS) for x in (a, b))
        return pa.array((left == right).sum(axis=1) >= plan.least_matches())

    side = [sketches.select(F.col("doc").alias(end), F.col("size").alias(f"size_{end}"),
                            F.col("sketch").alias(f"sketch_{end}")) for end in "ab"]
    sized = pairs.join(side[0], "a").join(side[1], "b").where(
        100 * F.least("size_a", "size_b") >= plan.percent * F.greatest("size_a", "size_b"))
    return sized.where(F.arrow_udf(near, "boolean")("sketch_a", "sketch_b")).select("a", "b")


def _with_counts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of several documents with their count and ends; the rows in nodes of three and more.

    Counts are combined before the exchange and joined back, so that a node of any size is
    spread over tasks.
    """
    counts = written(rows.groupBy("node").agg(F.count("*").alias("count"), F.min("doc").alias("a"),
                                              F.max("doc").alias("b")).where("a <> b"), "nodes")
    return counts, rows.join(counts.where("count > 2").select("node", "count"), "node")


def _nodes(sets: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The pairs that are alone in a node, the members (node, doc, side) of the larger small nodes, and the documents
    (doc) whose nodes lie too deep for the trees, None if no node went so far.

    ``side`` is 0 where all pairs of the node count, else 1 or 2 for a pair of blocks.
    """
    def part(coordinate: str) -> str:
        return f"substring(minima, 4 * ({coordinate}) + 1, 4)"

    first = [f"named_struct('tree', {tree}, 'node', xxhash64({tree}, {part(str(at))}))"
             for tree, at in enumerate(plan.coordinate(0))]
    rows = sets.select("doc", F.explode(F.expr(f"array({', '.join(first)})")).alias("x")).select("x.*", "doc")
    alone, members, level, safe = [], [], 0, plan.safe_levels()
    deep = None if safe else sets.select("doc").distinct()
    while True:
        counts, live = _with_counts(rows)
        alone.append(counts.where("count = 2").select("a", "b"))
        small = live.where(F.col("count") <= plan.node)
        members.append(small.select("node", "doc", F.lit(0).alias("side")))
        large = live.where(F.col("count") > plan.node).drop("count")
        if not counts.where(F.col("count") > plan.node).limit(1).count():
            break
        if "minima" not in large.columns:
            large = large.join(sets.select("doc", "minima"), "doc")
        level += 1
        if level > plan.depth:
            members.append(_blocks(large, counts, plan))
            break
        # documents of deeper nodes are also joined by rare shingles, so there the nodes are split faster
        ahead = range(level, level + (1 if level <= safe else FASTER))
        spread = ", ".join(part(f"element_at(array({', '.join(map(str, plan.coordinate(at)))}), tree + 1)")
                           for at in ahead)
        rows = written(large.select("tree", F.expr(f"xxhash64(node, {spread})").alias("node"), "doc", "minima"),
                       "large-nodes")
        # one tree that goes on is enough: how deep a document comes depends on what it shares
        if level == safe:
            deep = rows.select("doc").distinct()
        level = ahead[-1]
    return _union(alone), _union(members), deep


def _blocks(large: DataFrame, counts: DataFrame, plan: Plan, *others: str) -> DataFrame:
    """Members of nodes that no further function splits, as all pairs of blocks of half a node's size; ``others`` are
    columns that go with them."""
    wide = counts.where(F.col("count") > plan.node).withColumn(
        "blocks", F.ceil(F.col("count") * 4 / plan.node).cast("int")).select("node", "blocks")
    held = large.select("node", "doc", *others).join(wide, "node").withColumn(
        "block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    return held.select("doc", *others, "node", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) \
        .select(F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("node"), "doc",
                *others, F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
                .alias("side"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _sets_of(ids: DataFrame, docs: DataFrame, plan: Plan) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids(doc_id)``."""
    ids = written(ids.distinct(), "pair-ids")
    few = ids.count() <= plan.listed
    return written(shingle_sets(docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi"), plan.words),
                   "shingle-sets")


def confirmed(pairs: DataFrame, docs: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs, plan)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y")).cast("long")
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", common.alias("common"), (F.size("x").cast("long") + F.size("y")).alias("total")) \
        .where(100 * F.col("common") >= plan.percent * (F.col("total") - F.col("common"))).select("a", "b")


# ---------------------------------------------------------------- documents in deep nodes

#: Shingles are counted by this many of their bits, so the counts have one size for any table.
_COUNTED = 18


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - _COUNTED)).astype(np.int64)


def shingle_counts(docs: DataFrame, words: int) -> np.ndarray:
    """How often shingles of each bucket stand in ``docs``; orders them by rarity, roughly, which is enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _COUNTED, np.int64)
        for batch in batches:
            for shingles in text_bytes.shingle_sets(batch.column("text"), words):
                np.add.at(total, _bucket(shingles), 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    summed = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")) \
        .toArrow()
    counts = np.zeros(1 << _COUNTED, np.int64)
    counts[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return counts


def rare_shingles(docs: DataFrame, counts: np.ndarray, plan: Plan) -> DataFrame:
    """(node, doc, size, place, short): the rarest shingles of each set, enough that near sets share one.

    Of a near pair the first common shingle, in any one order of all shingles, stands among the first
    n - ceil(t n) + 1 of the larger set and, as ``short`` says, the first n - ceil(2 t n / (1 + t)) + 1 of the other.
    """
    schema = pa.schema([("node", pa.int64()), ("doc", pa.int64()), ("size", pa.int64()), ("place", pa.int64()),
                        ("short", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = text_bytes.shingle_sets(batch.column("text"), plan.words)
            for doc, shingles in zip(batch.column("doc_id").to_pylist(), sets):
                n = len(shingles)
                if not n:
                    continue
                long = n - -(-plan.percent * n // 100) + 1
                short = n - -(-2 * plan.percent * n // (100 + plan.percent)) + 1
                first = shingles[np.lexsort((shingles, counts[_bucket(shingles)]))[:long]]
                place = np.arange(len(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first.view(np.int64)), pa.array(np.full(len(first), doc)),
                     pa.array(np.full(len(first), n)), pa.array(place), pa.array(place < short)], schema=schema)

    return docs.mapInArrow(run, "node long, doc long, size long, place long, short boolean")


def crossing_pairs(members: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) of different components that share a node of ``members(..., component, place)`` and that
    sizes, places and sketches allow to be near."""
    def pairs(table: pa.Table) -> pa.RecordBatch:
        node, doc, size, side, group, sketch = _columns(table)
        left_over = size - table.column("place").to_numpy()
        ends, rows, shift = [np.zeros((2, 0), np.int64)], np.arange(len(node)), 1
        while True:
            rows = rows[rows + shift < len(node)]
            rows = rows[node[rows] == node[rows + shift]]
            if not len(rows):
                break
            other = rows + shift
            # what is common comes from the shared shingle on
            common = np.minimum(left_over[rows], left_over[other])
            wanted = (group[rows] != group[other]) & ((side[rows] != side[other]) | (side[rows] == 0)) & (
                (100 + plan.percent) * common >= plan.percent * (size[rows] + size[other]))
            i, j = rows[wanted], other[wanted]
            near = (sketch[i] == sketch[j]).sum(axis=1) >= plan.least_matches()
            i, j = doc[i[near]], doc[j[near]]
            ends.append(np.stack([np.minimum(i, j), np.maximum(i, j)]))
            shift += 1
        found = np.unique(np.concatenate(ends, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    return _by_node(members, pairs, "a long, b long").distinct()


def deep_links(deep: DataFrame, docs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame | None:
    """Links (a, b) between components of the documents ``deep(doc, component)``, None if there is nothing to find."""
    ends = deep.agg(F.min("component"), F.max("component")).first()
    if ends[0] == ends[1]:
        return None
    ids = deep.select(F.col("doc").alias("doc_id"))
    texts = written(docs.join(F.broadcast(ids) if deep.count() <= plan.listed else ids, "doc_id", "left_semi"),
                    "deep-texts")
    rare = written(rare_shingles(texts, shingle_counts(texts, plan.words), plan), "rare-shingles").join(deep, "doc")
    nodes = written(rare.groupBy("node").agg(F.count("*").alias("count"), F.min("component").alias("low"),
                                             F.max("component").alias("high"), F.max("short").alias("short"))
                    .where("low <> high AND short").select("node", "count"), "rare-nodes")
    live = rare.join(nodes, "node").drop("short")
    small = live.where(F.col("count") <= plan.node).withColumn("side", F.lit(0)).drop("count")
    large = live.where(F.col("count") > plan.node)
    apart = _blocks(large, nodes, plan, "size", "place", "component")
    members = small.unionByName(apart).join(sets.select("doc", "size", "sketch"), ["doc", "size"])
    return confirmed(written(crossing_pairs(members, plan), "deep-pairs"), docs, plan)


# ---------------------------------------------------------------- the operator

def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, trees: int = 20, node: int = 1_024,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, the set holds the
    distinct windows of ``words`` words (a shorter text is one window); sets
    are linked if the intersection is at least ``percent`` percent of the
    union, and component_id is the smallest id that links reach.

    A null or empty text, or one without words, has no shingles and is its own
    component. A null id takes no part and keeps a null component and kept.
    Rows that repeat an id share its component. Other columns of ``docs``, of
    whatever names, play no role. An empty table gives no rows.
    """
    prepared(docs.sparkSession)
    plan = Plan(words=words, percent=percent, trees=trees, node=node)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = written(signed(docs, words), "signatures")
    name = ["n_shingles", "h1", "h2"]
    usable = base.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = written(usable.groupBy(*name).agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
                     .where("n > 1").drop("n"), "copies")
    known = F.broadcast(copies) if copies.count() <= plan.listed else copies
    named = usable.join(known, name, "left").withColumn("first", F.coalesce("first", "doc_id"))
    sets = named.where("first = doc_id").select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("size"),
                                                "minima", "sketch")
    alone, members, deep = _nodes(sets, plan)
    members = written(members, "members")

    def sketched(rows: DataFrame) -> DataFrame:
        return rows.join(sets.select("doc", "size", "sketch"), "doc")

    lone = alike(alone.distinct(), sets, plan)
    pairs = written(candidate_pairs(sketched(members), plan).union(lone).distinct(), "pairs")
    links = written(confirmed(pairs, docs, plan), "confirmed")
    groups = written(components(links), "groups")

    placed = members.join(groups, members["doc"] == groups["node"], "left").select(
        members["node"], "doc", "side", F.coalesce("component", "doc").alias("component"))
    mixed = placed.groupBy("node").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
        .where("low <> high").select("node")
    open_ = placed.join(mixed, "node", "left_semi")
    near = written(still_near(sketched(open_), plan), "still-near")
    if near.limit(1).count():
        shingles = _sets_of(near.select(F.col("doc").alias("doc_id")), docs, plan) \
            .select(F.col("doc_id").alias("doc"), "shingles")
        links = written(links.union(confirmed_within(near.join(shingles, "doc"), plan)), "links-within")
        groups = written(components(links), "groups")
    if deep is not None:
        placed = written(deep.join(groups, deep["doc"] == groups["node"], "left").select(
            "doc", F.coalesce("component", "doc").alias("component")), "deep")
        further = deep_links(placed, docs, sets, plan)
        if further is not None:
            groups = components(links.union(further))

    groups = groups.select(F.col("node").alias("first"), "component")
    ends = base.select("doc_id", *name).join(known, name, "left") \
        .withColumn("first", F.coalesce("first", "doc_id")).join(groups, "first", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first"))
    return ends.select("doc_id", "n_shingles", component.alias("component_id"),
                       (F.col("doc_id") == component).alias("kept"))
