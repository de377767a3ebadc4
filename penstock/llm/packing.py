"""Packing of token ids into sequences of bounded length, by multiway differencing.

A document's ids are cut into whole sequences and a rest; the rests, of which
some give small end pieces, are dealt over as few windows as their sum allows.
The dealing is Karmarkar and Karp's: every piece starts as a partition with one
filled window, and the two partitions with the largest imbalance are merged,
the fullest window of one with the emptiest of the other, until one partition
with near-equal windows is left. If a window exceeds the capacity, the number
of windows rises and the dealing is repeated.

Each task packs the documents it reads, in groups of bounded size; nothing is
shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm.store import prepared

#: Windows dealt at a time.
GROUP_WINDOWS = 64
#: Every second rest gives small end pieces of these shares, which even the windows out; the others stay whole.
END_SHARES, ENDS_OF = (64, 16), 2
#: Ids per window that a group leaves free, so that near-equal windows stay below the capacity.
SLACK = 3

PACKED = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def differenced(sizes: list[int], windows: int) -> list[list[int]]:
    """Numbers of the pieces in each of ``windows`` near-equal windows."""
    queue = []
    for number, size in enumerate(sizes):
        sums = [0] * (windows - 1) + [size]
        heap_key = (-size, number)
        queue.append((*heap_key, sums, [[]] * (windows - 1) + [[number]]))
    heapq.heapify(queue)
    count = len(sizes)
    while len(queue) > 1:
        _, _, sums, held = heapq.heappop(queue)
        _, _, other, more = heapq.heappop(queue)
        # fullest with emptiest: both lists run from the emptiest to the fullest
        merged = sorted(((a + b, x, y) for a, b, x, y in zip(sums, reversed(other), held, reversed(more))),
                        key=lambda m: m[0])
        base = merged[0][0]
        heapq.heappush(queue, (base - merged[-1][0], count, [m[0] for m in merged],
                               [m[1] + m[2] if m[1] and m[2] else m[1] or m[2] for m in merged]))
        count += 1
    return queue[0][3] if queue else [[] for _ in range(windows)]


def dealt(sizes: list[int], capacity: int) -> list[list[int]]:
    """The windows of ``differenced`` with the least count whose fullest window holds at most ``capacity``."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differenced(sizes, windows)
        if all(sum(sizes[i] for i in window) <= capacity for window in found):
            return [window for window in found if window]
        windows += 1


def cut(doc_tokens: int, capacity: int, ends: bool = True) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(start, length) of the whole sequences, and of the pieces of the rest: one, or with small ``ends`` three."""
    whole = [(at, capacity) for at in range(0, doc_tokens - capacity + 1, capacity)]
    start = len(whole) * capacity
    rest = doc_tokens - start
    sizes = [rest // share for share in END_SHARES if rest // share >= 4] if ends else []
    edges = [start]
    for size in (rest - sum(sizes), *sizes):
        edges.append(edges[-1] + size)
    return whole, [(a, b - a) for a, b in zip(edges, edges[1:]) if b > a]


def pack(docs: DataFrame, encoder: Callable[[], Callable[[list[str]], list[bytes]]], capacity: int = 2048,
         end_id: int = 1, group_windows: int = GROUP_WINDOWS, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all documents in ``docs``.

    ``encoder()`` makes, once per task, a function from texts to their ids as
    little-endian unsigned 32-bit integers. ``end_id`` ends each document.
    ``start`` counts the document's ids before the piece, ``offset`` the ids
    before it in its sequence; ``ids`` has the piece's ids in the same bytes.
    Sequences hold at most ``capacity`` ids and are numbered within each task,
    above the task's number times 2**36.

    A null or empty text is the end id alone. A null id is carried as it is.
    Rows that repeat an id are packed each on its own. Other columns, of
    whatever names, play no role. An empty table gives no pieces.
    """
    prepared(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       F.spark_partition_id().alias("task"))
    last = np.array([end_id], "<u4").tobytes()
    limit = (capacity - min(SLACK, capacity // 64)) * group_windows

    def flush(group: list[tuple], number: int, out: list[tuple]) -> int:
        for window in dealt([length for _, _, length, _, _ in group], capacity):
            offset = 0
            for i in window:
                doc, start, length, ids, tokens = group[i]
                out.append((doc, start, length, ids, tokens, number, offset))
                offset += length
            number += 1
        return number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        group: list[tuple] = []
        held, number, rests = 0, None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                if number is None:
                    number = part.column("task")[0].as_py() << 36
                out: list[tuple] = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text").to_pylist())):
                    ids += last
                    tokens = len(ids) // 4
                    whole, rest = cut(tokens, capacity, rests % ENDS_OF == 0)
                    rests += bool(rest)
                    for start, length in whole:
                        out.append((doc, start, length, ids[4 * start:4 * (start + length)], tokens, number, 0))
                        number += 1
                    for start, length in rest:
                        if held + length > limit:
                            number = flush(group, number, out)
                            group, held = [], 0
                        group.append((doc, start, length, ids[4 * start:4 * (start + length)], tokens))
                        held += length
                if out:
                    yield _pieces(out)
        out = []
        if group:
            flush(group, number, out)
        if out:
            yield _pieces(out)

    return rows.mapInArrow(run, PACKED)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [field.split()[0] for field in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
