"""Byte n-grams of words, hashed at every position of a slice of texts at once.

A word counts with one space on either side, so that a gram can begin or end
a word. Grams never reach over a space.
"""

from __future__ import annotations

import numpy as np

from penstock.llm import text_bytes

_FACTOR = np.uint32(0x01000193)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one space before, between and after; the place of each word's space, and its text.

    A word that repeats the one before it is left out, so that a run of one
    word weighs as much as the word.
    """
    lower = text_bytes.LOWER[data]
    starts, ends, owner = text_bytes.words(lower, offsets)
    codes = text_bytes.range_hashes(lower, starts, ends)
    kept = np.ones(len(starts), bool)
    kept[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    starts, ends, owner = starts[kept], ends[kept], owner[kept]
    size = ends - starts
    places = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(places[-1] + 1, 0x20, np.uint8)
    source = np.arange(size.sum()) + np.repeat(starts - (places[:-1] - np.arange(len(size))), size)
    out[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size) + 1] = lower[source]
    return out, places[:-1], owner


def hashed(text: np.ndarray, sizes: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each gram length, the start of each gram and its 32-bit hash, in order."""
    gap = text == 0x20
    out = []
    total = np.zeros(len(text), np.uint32)
    for size in range(1, max(sizes) + 1):
        held = len(text) - size + 1
        if held <= 0:
            out += [(np.zeros(0, np.int64), np.zeros(0, np.uint32))] * (size in sizes)
            continue
        total = total[:held] * _FACTOR + text[size - 1:size - 1 + held] + np.uint32(1)
        if size in sizes:
            crossing = np.zeros(held, bool)
            for inner in range(1, size - 1):
                crossing |= gap[inner:inner + held]
            if size == 1:
                crossing = gap[:held]
            else:
                crossing |= gap[:held] & gap[size - 1:size - 1 + held]
            at = np.flatnonzero(~crossing)
            codes = total[at] ^ (total[at] >> np.uint32(15))
            codes = (codes + np.uint32(size)) * np.uint32(0x85EBCA6B)
            out.append((at, codes ^ (codes >> np.uint32(13))))
    return out
