"""Shingle sets of documents as a column of hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from penstock.llm import text_bytes


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles): the whole set of every document of ``docs(doc_id, text)``, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets, held = batch.column("doc_id"), [], 0
            first = 0
            for i, shingles in enumerate(text_bytes.shingle_sets(batch.column("text"), words)):
                sets.append(shingles.view(np.int64))
                held += len(shingles)
                if held > 1 << 20:
                    yield _set_batch(ids.slice(first, i + 1 - first), sets)
                    first, sets, held = i + 1, [], 0
            yield _set_batch(ids.slice(first), sets)

    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


def _set_batch(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
    values = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), values)],
                                      names=["doc_id", "shingles"])
