"""Texts of an Arrow column as bytes in numpy: slices of bounded size, words, hashes.

Everything here works on whole slices at once; no Python object is made per
word. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; one longer document is a slice of its own.
SLICE_BYTES = 1 << 20

#: ``[\x20\x09-\x0D]``, what parts words.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_CODES = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, their bytes, offsets of the texts in these)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    count = len(column)
    if not count:
        return
    offsets = np.frombuffer(places, width)[column.offset:column.offset + count + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last, raw[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word, in order."""
    inside = ~SEPARATOR[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(offsets, starts, side="right") - 1


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        factors = np.full(size, base, dtype=np.uint64)
        factors[:1] = 1
        return np.multiply.accumulate(factors)
    return of(_BASE), of(pow(_BASE, -1, 2**64))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, equal ranges alike wherever they stand."""
    size = 1 << max(20, int(len(data) + 1).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[:len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mixed(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(codes: np.ndarray, texts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each window of ``size`` words; a text with fewer words has one, of all of them."""
    factors = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    count = len(codes)
    total = np.zeros(count, dtype=np.uint64)
    held = np.zeros(count, dtype=np.int64)
    for i in range(min(size, count)):
        same = texts[i:] == texts[:count - i] if i else np.ones(count, dtype=bool)
        part = np.where(same, codes[i:], np.uint64(0)) * factors[i]
        total[:count - i] += part
        held[:count - i] += same
    first = np.ones(count, dtype=bool)
    first[1:] = texts[1:] != texts[:-1]
    kept = (held == size) | (first & (held < size))
    return mixed(total[kept] + held[kept].astype(np.uint64)), texts[kept]


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, A-Z lower-cased, sorted."""
    for first, last, data, offsets in slices(column):
        lower = LOWER[data]
        starts, ends, texts = words(lower, offsets)
        hashes, owner = shingle_hashes(range_hashes(lower, starts, ends), texts, size)
        bounds = np.searchsorted(owner, np.arange(last - first + 1))
        for i in range(last - first):
            yield np.unique(hashes[bounds[i]:bounds[i + 1]])
