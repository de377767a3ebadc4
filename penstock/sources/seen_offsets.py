"""Keyed state of a stream: which offsets were seen, as bits of blocks and ranges of full blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Runs of 1,024 offsets are dealt over the shares; a share numbers its own and keeps 65,536 in a block.
RUN_BITS, BLOCK_BITS = 10, 16


def share_of(offset: Column, shares: int) -> Column:
    """The share of its partition that an offset belongs to."""
    return F.pmod(F.shiftright(offset.cast("long"), RUN_BITS), F.lit(shares)).cast("int")


def slots_in_share(offsets: np.ndarray, shares: int) -> np.ndarray:
    """The number of each offset in its share, in the same order and without gaps where offsets have none."""
    return ((offsets >> RUN_BITS) // shares << RUN_BITS) | (offsets & ((1 << RUN_BITS) - 1))


def merged_ranges(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges (first and last offset, in order) with ``offsets`` (distinct, in order) added, and which of these are new."""
    at = np.searchsorted(starts, offsets, side="right") - 1
    new = (at < 0) | (offsets > ends[at]) if len(starts) else np.ones(len(offsets), bool)
    starts = np.concatenate([starts, offsets[new]])
    ends = np.concatenate([ends, offsets[new]])
    order = np.argsort(starts)
    starts, ends = starts[order], ends[order]
    apart = starts[1:] > ends[:-1] + 1
    edge = np.ones(min(1, len(starts)), bool)
    return starts[np.concatenate([edge, apart])], ends[np.concatenate([apart, edge])], new


class SeenOffsets(StatefulProcessor):
    """Lets each offset of a share (:func:`share_of`) of a key through once.

    A batch reads and writes the blocks that its offsets lie in and no others, so that its cost does not grow with
    the gaps of all earlier ones. Full blocks are kept as ranges, one while offsets come without gaps.
    """

    def __init__(self, offset: str, columns: list[str], shares: int) -> None:
        self.offset, self.columns, self.shares = offset, columns, shares

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.full = handle.getValueState("full", "starts array<bigint>, ends array<bigint>")
        self.open = handle.getMapState("open", "block bigint", "seen binary")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        for frame in rows:
            frame = frame.drop_duplicates(self.offset)
            frame = frame.sort_values(self.offset)
            new = self._unseen(slots_in_share(frame[self.offset].to_numpy(np.int64), self.shares))
            yield frame.loc[new, self.columns]

    def _unseen(self, slots: np.ndarray) -> np.ndarray:
        """Which of the slots (distinct, in order) are new; they count as seen from now on."""
        blocks, begins = np.unique(slots >> BLOCK_BITS, return_index=True)
        starts, ends = (np.array(x, np.int64) for x in self.full.get() or ([], []))
        partly = merged_ranges(starts, ends, blocks)[2]
        new, filled = [], []
        for block, inside, part in zip(blocks.tolist(), np.split(slots & ((1 << BLOCK_BITS) - 1), begins[1:]), partly):
            if not part:
                new.append(np.zeros(len(inside), bool))
                continue
            held = self.open.getValue((block,))
            seen = (np.unpackbits(np.frombuffer(zlib.decompress(held[0]), np.uint8)) if held
                    else np.zeros(1 << BLOCK_BITS, np.uint8))
            new.append(seen[inside] == 0)
            seen[inside] = 1
            if seen.all():
                filled.append(block)
                if held:
                    self.open.removeKey((block,))
            elif new[-1].any():
                self.open.updateValue((block,), (zlib.compress(np.packbits(seen).tobytes(), 1),))
        if filled:
            starts, ends, _ = merged_ranges(starts, ends, np.array(filled))
            self.full.update((starts.tolist(), ends.tolist()))
        return np.concatenate(new)

    def close(self) -> None:
        pass
