"""Exact line de-duplication through a sharded minimal perfect hash.

Every eligible line of every document is hashed. The distinct hashes are dealt
into shards of bounded size; each shard becomes a minimal perfect hash (a
cascade of bit arrays with ranks) over three compact arrays: fingerprints,
document counts and last holders. Documents send their hashes to the shards and
probe the arrays; the lines themselves are neither joined nor moved.

A line that very many documents hold makes its shard hot. Such shards, of which
there are at most ``HOT``, are copied, and their entries dealt over the copies;
a task streams the entries of a copy past its arrays, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm import text_bytes
from penstock.llm.store import prepared, written

#: Distinct lines per shard, on average.
SHARD_LINES = 32_768
#: A shard with more than one of so many parts of all entries is hot; there are at most so many.
HOT = 1_000
#: Bits per key at each level of the hash.
SPREAD = 2
#: Counts are kept in one byte.
MOST_COUNTED = 255


# ---------------------------------------------------------------- lines of texts

def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end and text number of every line of a slice; a text without \\n is one line, also when empty."""
    breaks = np.flatnonzero(data == 0x0A)
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    texts = np.concatenate([owner, np.arange(len(offsets) - 1)])
    ends = np.concatenate([breaks, offsets[1:]])
    order = np.lexsort((ends, texts))
    texts, ends = texts[order], ends[order]
    starts = np.zeros_like(ends)
    starts[1:] = ends[:-1] + 1
    first = np.ones(len(ends), dtype=bool)
    first[1:] = texts[1:] != texts[:-1]
    starts[first] = offsets[texts[first]]
    return starts, ends, texts


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Two 64-bit hashes of each line's key, and whether the key is long enough."""
    inside = ~text_bytes.SEPARATOR[data]
    place = np.arange(len(data))
    ahead = np.full(len(data) + 1, len(data))
    ahead[:-1] = np.minimum.accumulate(np.where(inside, place, len(data))[::-1])[::-1]
    behind = np.zeros(len(data) + 1, dtype=np.int64)
    behind[1:] = np.maximum.accumulate(np.where(inside, place + 1, 0))
    opens, closes = np.minimum(ahead[starts], ends), np.maximum(behind[ends], starts)
    closes = np.maximum(closes, opens)
    points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    lower = text_bytes.LOWER[data]
    one = text_bytes.range_hashes(lower, opens, closes)
    two = text_bytes.range_hashes(lower ^ 0x5A, opens, closes)
    return one.view(np.int64), two.view(np.int64), points[closes] - points[opens] >= least


def line_entries(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, h1, h2): each document's distinct eligible lines by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, last, data, offsets in text_bytes.slices(batch.column("text")):
                starts, ends, texts = _lines(data, offsets)
                h1, h2, long = _keys(data, starts, ends, least)
                h1, h2, texts = h1[long], h2[long], texts[long]
                order = np.lexsort((h2, h1, texts))
                h1, h2, texts = h1[order], h2[order], texts[order]
                new = np.ones(len(h1), dtype=bool)
                new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (texts[1:] != texts[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first:last][texts[new]].astype(np.int64)), pa.array(h1[new]), pa.array(h2[new])],
                    names=["doc_id", "h1", "h2"])

    return docs.select("doc_id", "text").where("doc_id IS NOT NULL").mapInArrow(run, "doc_id long, h1 long, h2 long")


# ---------------------------------------------------------------- the hash

def _places(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
    return (text_bytes.mixed(h1.view(np.uint64) + text_bytes.mixed(h2.view(np.uint64) + salt)) % np.uint64(size)) \
        .astype(np.int64)


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], bytes]:
    """Level sizes and bits of a minimal perfect hash over distinct (h1, h2).

    A key owns a bit at the first level where no other key wants it; its number
    is the count of set bits before that one.
    """
    sizes, levels = [], []
    while len(h1):
        size = max(64, SPREAD * len(h1))
        at = _places(h1, h2, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        left = ~alone[at]
        h1, h2 = h1[left], h2[left]
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    return sizes, np.packbits(bits).tobytes()


class PerfectHash:
    """Numbers 0..n-1 for the n keys it was built over; any number, or -1, for others."""

    def __init__(self, sizes: list[int], bits: bytes) -> None:
        self.sizes = sizes
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8))[:sum(sizes)].astype(bool)
        self.rank = np.cumsum(self.bits) - 1

    def numbers(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.full(len(h1), -1, dtype=np.int64)
        open_, base = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = base + _places(h1[open_], h2[open_], level, size)
            hit = self.bits[at]
            found[open_[hit]] = self.rank[at[hit]]
            open_, base = open_[~hit], base + size
        return found


INDEX = "shard long, sizes array<long>, bits binary, fingerprints binary, counts binary, holders binary"


def line_index(lines: DataFrame, shards: int) -> DataFrame:
    """One row per shard of ``lines(h1, h2, n_docs, holder)``: the hash and its arrays."""
    def build(key: tuple, table: pa.Table) -> pa.Table:
        h1, h2, count, holder = (table.column(c).to_numpy() for c in ("h1", "h2", "n_docs", "holder"))
        sizes, bits = build_hash(h1, h2)
        number = PerfectHash(sizes, bits).numbers(h1, h2)
        prints = np.empty(len(h1), np.uint32)
        counts = np.empty(len(h1), np.uint8)
        holders = np.empty(len(h1), np.int64)
        prints[number] = h2.view(np.uint64).astype(np.uint32)
        counts[number] = np.minimum(count, MOST_COUNTED)
        holders[number] = holder
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "sizes": pa.array([sizes], pa.list_(
            pa.int64())), "bits": [bits], "fingerprints": [prints.tobytes()], "counts": [counts.tobytes()],
            "holders": [holders.tobytes()]})

    return lines.withColumn("shard", F.pmod("h1", F.lit(shards))).groupBy("shard").applyInArrow(build, INDEX)


def copies(lines: DataFrame, shards: int, total: int) -> DataFrame:
    """(shard, copies) of the hot shards, copied so that no copy answers more than one ``HOT``-th of all entries."""
    most = total // HOT + 1
    return lines.groupBy(F.pmod("h1", F.lit(shards)).alias("shard")).agg(F.sum("n_docs").alias("n")) \
        .where(F.col("n") > most).select("shard", F.ceil(F.col("n") / most).cast("int").alias("copies"))


_ARRAYS = ("sizes", "bits", "fingerprints", "counts", "holders")


def probed(entries: DataFrame, index: DataFrame, hot: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """The entries (doc_id, h1, h2) of lines to drop, looked up in the arrays of their shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays: tuple | None = None
        for batch in batches:
            edges = np.flatnonzero(batch.column("bits").is_valid().to_numpy(zero_copy_only=False))
            for first, last in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if first == last:
                    continue
                part = batch.slice(first, last - first)
                if part.column("bits")[0].is_valid:
                    row = {c: part.column(c)[0].as_py() for c in _ARRAYS}
                    arrays = (PerfectHash(row["sizes"], row["bits"]), np.frombuffer(row["fingerprints"], np.uint32),
                              np.frombuffer(row["counts"], np.uint8), np.frombuffer(row["holders"], np.int64))
                    part = part.slice(1)
                if part.num_rows:
                    yield _drops(part, *arrays)

    def _drops(asked: pa.RecordBatch, names: PerfectHash, prints: np.ndarray, counts: np.ndarray,
               holders: np.ndarray) -> pa.RecordBatch:
        doc, h1, h2 = (asked.column(c).to_numpy() for c in ("doc_id", "h1", "h2"))
        number = names.numbers(h1, h2)
        known = (number >= 0) & (prints[number] == h2.view(np.uint64).astype(np.uint32))
        drop = known & (counts[number] >= min_docs) & (holders[number] != doc)
        return pa.RecordBatch.from_arrays([pa.array(x[drop]) for x in (doc, h1, h2)], names=["doc_id", "h1", "h2"])

    few = F.broadcast(hot)
    many = F.coalesce("copies", F.lit(1))
    kinds = dict(index.dtypes)
    asked = entries.withColumn("shard", F.pmod("h1", F.lit(shards))).join(few, "shard", "left").select(
        "shard", F.pmod(F.xxhash64("doc_id"), many).cast("int").alias("copy"), "doc_id", "h1", "h2",
        *[F.lit(None).cast(kinds[c]).alias(c) for c in _ARRAYS])
    told = index.join(few, "shard", "left").select(
        "shard", F.explode(F.sequence(F.lit(0), many - 1)).alias("copy"),
        *[F.lit(None).cast("long").alias(c) for c in ("doc_id", "h1", "h2")], *_ARRAYS)
    # a copy's arrays come before its entries
    return asked.unionByName(told).repartition("shard", "copy").sortWithinPartitions(
        "shard", "copy", F.col("bits").isNull()).mapInArrow(run, "doc_id long, h1 long, h2 long")


# ---------------------------------------------------------------- the operator

def line_dedup(docs: DataFrame, least: int = 20, min_docs: int = 3, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines removed from the text, and n_lines, n_dropped (long).

    A text is split at \\n; a line's key has ``[\\x20\\x09-\\x0D]`` stripped at
    both ends and A-Z lower-cased. Keys of at least ``least`` code points in
    at least ``min_docs`` (up to 255) ids lose all their lines except in the
    largest id that holds them; several rows with one id count once, and with the largest all keep theirs.

    A null text is one empty line and comes back empty. A row with a null id
    keeps all its lines and counts for none. Other columns pass through; one
    named n_lines or n_dropped gives way. An empty table stays empty.
    """
    if not 2 <= min_docs <= MOST_COUNTED:
        raise ValueError(f"min_docs must lie between 2 and {MOST_COUNTED}")
    prepared(docs.sparkSession)
    passed = [c for c in docs.columns if c not in (id_col, text_col, "n_lines", "n_dropped")]
    rest = F.struct(*[F.col(f"`{c}`") for c in passed]) if passed else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"), rest.alias("rest"))
    entries = written(line_entries(rows, least), "line-entries")
    lines = written(entries.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n_docs"),
                                                    F.max("doc_id").alias("holder")), "lines")
    total, distinct = entries.count(), lines.count()
    shards = max(1, -(-distinct // SHARD_LINES))
    index = written(line_index(lines, shards), "line-index")
    dropped = probed(entries, index, copies(lines, shards, total), shards, min_docs)
    drops = dropped.groupBy("doc_id").agg(F.collect_list("h1").alias("d1"), F.collect_list("h2").alias("d2"))
    joined = rows.join(drops, "doc_id", "left")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            d1, d2 = batch.column("d1"), batch.column("d2")
            for first, last, data, offsets in text_bytes.slices(batch.column("text")):
                starts, ends, owner = _lines(data, offsets)
                h1, h2, long = _keys(data, starts, ends, least)
                bounds = np.searchsorted(owner, np.arange(last - first + 1))
                raw = data.tobytes()
                for i in range(last - first):
                    lo, hi = bounds[i], bounds[i + 1]
                    n_lines.append(hi - lo)
                    gone = d1[first + i].as_py()
                    if not gone:
                        n_dropped.append(0)
                        texts.append(raw[offsets[i]:offsets[i + 1]])
                        continue
                    pairs = set(zip(gone, d2[first + i].as_py()))
                    keep = [k for k in range(lo, hi) if not (long[k] and (int(h1[k]), int(h2[k])) in pairs)]
                    n_dropped.append(hi - lo - len(keep))
                    texts.append(b"\n".join(raw[starts[k]:ends[k]] for k in keep))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), batch.column("rest"),
                 pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=["doc_id", "text", "rest", "n_lines", "n_dropped"])

    kind = dict(rows.dtypes)
    out = joined.mapInArrow(rebuild, f"doc_id long, text string, rest {kind['rest']}, n_lines long, n_dropped long")
    columns = [F.col("doc_id").alias(c) if c == id_col else F.col("text").alias(c) if c == text_col
               else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*columns, "n_lines", "n_dropped")
