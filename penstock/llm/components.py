"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm.store import written

#: Links of a task that are joined to stars at once, at most.
HELD = 1 << 18
#: Links for which a round has one task.
SHARE = 1 << 14


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links with the same components, every node pointed to the smallest that the links at hand reach."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (above := up.get(x, x)) != x:
            up[x] = x = up.get(above, above)
        return x

    def flushed() -> pa.RecordBatch:
        ends = [(x, y) for x in up if (y := root(x)) != x]
        up.clear()
        return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in (zip(*ends) if ends else ([], []))],
                                          names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        if len(up) > HELD:
            yield flushed()
    if up:
        yield flushed()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; a component is named by its smallest node.

    Each round joins the links at hand in every task to stars, then points the
    larger neighbours of every node to the smallest one and each node to the
    smallest of its neighbours, which ends in one star per component after a
    number of rounds logarithmic in its width. What fits in one task's share is stars by then and
    needs no round. Minima are combined before the exchange and joined back, so the links of a
    hub are never gathered. A round that moves no link is the last. Links with a null end, and of a node to itself,
    say nothing. An empty table has no components.
    """
    def joined(frame: DataFrame) -> DataFrame:
        return written(frame.mapInArrow(_stars, "u long, v long"), "links")

    links = joined(links.where("a <> b").select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")))
    while True:
        tasks = -(-links.count() // SHARE)
        links = joined(links.select("u", "v").coalesce(max(tasks, 1)))
        if tasks <= 1:
            break
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = written(both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v"), F.expr("m < u").alias("moved")).coalesce(tasks), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.max("moved").alias("moved"))
        # one of a node's links to its smallest neighbour stays, its other neighbours are pointed there
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"),
            (F.expr("v <> m") | least["moved"]).alias("moved"))
        links = written(small.groupBy("u", "v").agg(F.max("moved").alias("moved")).coalesce(tasks), "links")
        if not links.agg(F.max("moved")).first()[0]:
            break
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")),
                             F.struct(F.col("v").alias("node"), F.col("v").alias("component"))))
    return links.select(ends.alias("x")).select("x.*").distinct()
