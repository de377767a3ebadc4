"""Exact top-k search by inner product with vector-approximation files.

Vectors are dealt over groups of bounded size. A group's file holds for each
vector the cell (one byte) of every component. A block of queries scans the
cells: each cell's middle gives an estimate, the cells' widths an error that
cannot be exceeded, so every vector gets an upper and a lower bound of its
score. Vectors are then read exactly in the order of their upper bounds until
no bound left reaches the k-th exact score found.

Queries and vectors meet in blocks: the queries are copied to every group, the
groups to every slice of queries; only the k best of each group leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penstock.llm.store import prepared, written

#: Vectors of a group, and queries of a slice, on average.
GROUP_VECTORS, SLICE_QUERIES = 16_384, 8_192
#: Cells per component.
CELLS = 256
#: Queries scanned, and vectors read exactly, at once.
BLOCK = 128


class ApproximationFile:
    """Cells of a set of integer vectors, with the exact vectors beside them."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        real = vectors.astype(np.float64)
        self.low = real.min(axis=0)
        self.width = np.maximum((real.max(axis=0) - self.low) / CELLS, 1e-300)
        self.cells = np.clip(np.floor((real - self.low) / self.width), 0, CELLS - 1).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimate of every score and the most it can be wrong, from the cells alone."""
        real = queries.astype(np.float64)
        estimate = (real * self.width) @ (self.cells.astype(np.float64) + 0.5).T + (real @ self.low)[:, None]
        size = np.abs(real) @ (np.abs(self.low) + CELLS * self.width)
        return estimate, np.abs(real) @ (self.width / 2) * (1 + 1e-6) + 1e-9 * size + 1e-6

    def exact(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores as exact integers."""
        part = self.vectors[rows]
        most = np.abs(query.astype(np.float64)) @ np.abs(part.astype(np.float64)).max(axis=0)
        if most < 2**62:
            return part @ query
        return (part.astype(object) * query.astype(object)).sum(axis=1)

    def nearest(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> Iterator[list[tuple]]:
        """For each query its k best (score, id); vectors with the query's own id take no part."""
        for at in range(0, len(queries), BLOCK):
            block = queries[at:at + BLOCK]
            estimate, error = self.bounds(block)
            estimate[own[at:at + BLOCK, None] == ids[None, :]] = -np.inf
            for query, guess, wrong, mine in zip(block, estimate, error, own[at:at + BLOCK]):
                taken = min(k, len(ids))
                # no vector below the k-th lower bound can be among the k best
                floor = np.partition(guess, len(guess) - taken)[len(guess) - taken] - 2 * wrong
                rows = np.flatnonzero((guess >= floor) & np.isfinite(guess))
                rows = rows[np.argsort(-guess[rows], kind="stable")]
                best: list[tuple] = []
                for first in range(0, len(rows), BLOCK):
                    part = rows[first:first + BLOCK]
                    if len(best) == k and guess[part[0]] + wrong < best[-1][0]:
                        break
                    found = zip(self.exact(query, part).tolist(), ids[part].tolist())
                    best = sorted([*best, *found], key=lambda x: (-x[0], x[1]))[:k]
                yield best


def integer_vectors(frame: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, vector array<long>): floor(scale * x) of every component, of rows that can take part.

    A component beyond the range of a long is held at its end.
    """
    vector = F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda x: x * F.lit(float(scale)))
    whole = F.transform(vector, lambda x: F.floor(x).cast("long"))
    usable = F.coalesce(F.size(vector) > 0, F.lit(False)) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return frame.where(F.col(f"`{id_col}`").isNotNull() & F.coalesce(usable, F.lit(False))) \
        .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), whole.alias("vector"))


def top_k(vectors: DataFrame, query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each query row with all other rows.

    ``query`` tells, over the columns of ``vectors``, which rows are queries.
    Components are floor(``scale`` * x); scores are exact integers, held at the
    ends of a long. Ties go to the smaller id; ranks begin at 1; fewer than
    ``k`` other rows give fewer ranks.

    A row with a null id, or whose vector is null, empty or holds a null or
    non-finite component, takes no part. Vectors of different lengths do not
    meet. Rows that repeat a vec_id are all candidates, but none for a query of
    that id; a repeated query is answered once, by its first vector in order.
    Other columns play no role. An empty table gives no rows.
    """
    prepared(vectors.sparkSession)
    rows = integer_vectors(vectors, id_col, vector_col, scale).withColumn("size", F.size("vector"))
    asked = integer_vectors(vectors.where(query), id_col, vector_col, scale) \
        .groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("size", F.size("vector"))
    rows, asked = written(rows, "vectors"), written(asked, "vector-queries")
    count, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    groups = max(1, -(-count // GROUP_VECTORS), min(cores, count // 1024))
    slices = max(1, -(-asked.count() // SLICE_QUERIES))
    files = rows.select("size", "vec_id", "vector", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()),
                                                           F.expr(f"{groups}L")).alias("g"),
                        F.explode(F.expr(f"sequence(0L, {slices - 1}L)")).alias("s"))
    blocks = asked.select("size", "vec_id", "vector", F.expr(f"pmod(xxhash64(vec_id), {slices}L)").alias("s"),
                          F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("g"))
    keys = ["size", "g", "s"]

    def search(file: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(file) and len(block):
            ids = file["vec_id"].to_numpy()
            held = ApproximationFile(np.stack(file["vector"].to_numpy()))
            own = block["vec_id"].to_numpy()
            for q, best in zip(own.tolist(), held.nearest(np.stack(block["vector"].to_numpy()), own, ids, k)):
                found += [(q, vec, max(-2**63, min(2**63 - 1, score))) for score, vec in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    best = files.groupBy(*keys).cogroup(blocks.groupBy(*keys)) \
        .applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
