"""Token counts that follow edits: a segment tree over the pre-tokens of each document.

The leaves hold blocks of pre-tokens with their lengths and token counts, the
nodes above them sums. An edit descends to the pre-tokens it touches, cuts the
text anew from the last pre-token that cannot see the edit until a cut falls on
an old one behind it, counts the new pre-tokens only, and updates the sums on
the path to the root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm import bpe_trie
from penstock.llm.store import prepared

#: Pre-tokens per leaf when a tree is built.
LEAF = 64
#: Code points behind a pre-token that can change where it ends.
AHEAD = 2
#: Code points behind an edit that are cut at first; doubled until a cut falls on an old one.
WINDOW = 64

RESULT = "doc_id long, tokens_before long, tokens_after long, n_pieces long, n_recounted long"


class CountTree:
    """Lengths and token counts of a text's pre-tokens, with their sums."""

    def __init__(self, lengths: list[int], counts: list[int]) -> None:
        self.lengths = [lengths[i:i + LEAF] for i in range(0, len(lengths), LEAF)] or [[]]
        self.counts = [counts[i:i + LEAF] for i in range(0, len(counts), LEAF)] or [[]]
        self.leaves = 1 << (len(self.lengths) - 1).bit_length()
        self.chars = [0] * (2 * self.leaves)
        self.tokens = [0] * (2 * self.leaves)
        for i, (x, y) in enumerate(zip(self.lengths, self.counts)):
            self.chars[self.leaves + i], self.tokens[self.leaves + i] = sum(x), sum(y)
        for node in range(self.leaves - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def pieces(self) -> int:
        return sum(map(len, self.lengths))

    def locate(self, at: int) -> tuple[int, int, int]:
        """Leaf, place in it and start of the pre-token that holds the character ``at``, or the last one."""
        node, start = 1, 0
        while node < self.leaves:
            node *= 2
            if start + self.chars[node] <= at and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        leaf, place = node - self.leaves, 0
        lengths = self.lengths[leaf] if leaf < len(self.lengths) else []
        while place < len(lengths) - 1 and start + lengths[place] <= at:
            start += lengths[place]
            place += 1
        return leaf, place, start

    def replace(self, leaf: int, place: int, old: int, lengths: list[int], counts: list[int]) -> None:
        """Put pre-tokens in the place of ``old`` ones, from one on; sums above the touched leaves follow."""
        touched = {leaf}
        here = min(old, len(self.lengths[leaf]) - place)
        self.lengths[leaf][place:place + here] = lengths
        self.counts[leaf][place:place + here] = counts
        old -= here
        while old > 0:
            leaf += 1
            here = min(old, len(self.lengths[leaf]))
            del self.lengths[leaf][:here], self.counts[leaf][:here]
            old -= here
            touched.add(leaf)
        nodes = set()
        for leaf in touched:
            node = self.leaves + leaf
            self.chars[node], self.tokens[node] = sum(self.lengths[leaf]), sum(self.counts[leaf])
            nodes.add(node // 2)
        while nodes and max(nodes) > 0:
            for node in nodes:
                self._sum(node)
            nodes = {node // 2 for node in nodes if node > 1}

    def from_place(self, leaf: int, place: int) -> Iterator[int]:
        """Lengths of the pre-tokens from one on."""
        while leaf < len(self.lengths):
            yield from self.lengths[leaf][place:]
            leaf, place = leaf + 1, 0


def _cut(bpe: bpe_trie.TrieBpe, text: str) -> list[str]:
    """The pre-tokens of a text, cut by the library where it must be; a special token's mark is one of them."""
    out: list[str] = []
    for part in [text] if bpe.parts is None or "<" not in text else bpe.parts.split(text):
        if part in bpe.special:
            out.append(part)
        elif part:
            pieces = bpe.pieces(part)
            out += pieces if isinstance(pieces[0], str) else [x.decode() for x in pieces]
    return out


def _learn(bpe: bpe_trie.TrieBpe, words: set[str]) -> None:
    bpe.learn(words - bpe.special.keys())
    # no pre-token of other text reads like a mark
    bpe.known.update((x, np.array([number], "<u4").tobytes()) for x, number in bpe.special.items())


class CountedText:
    """A text with its tree; ``recounted`` is the number of pre-tokens counted since it was made."""

    def __init__(self, text: str, bpe: bpe_trie.TrieBpe, tree: CountTree | None = None,
                 pieces: list[str] | None = None) -> None:
        self.bpe, self.text, self.recounted = bpe, text, 0
        self.tree = tree if tree is not None else self._built(pieces)

    def _built(self, pieces: list[str] | None = None) -> CountTree:
        if pieces is None:
            pieces = _cut(self.bpe, self.text)
            _learn(self.bpe, set(pieces))
        return CountTree(list(map(len, pieces)), self._known(pieces))

    def _counts(self, pieces: list[str]) -> list[int]:
        _learn(self.bpe, set(pieces))
        return self._known(pieces)

    def _known(self, pieces: list[str]) -> list[int]:
        return [len(ids) // 4 for ids in map(self.bpe.known.__getitem__, pieces)]

    def _pieces_from(self, start: int, ahead: int) -> Iterator[str]:
        """The pre-tokens from one's start on, cut in windows; what a window's end may have changed is cut again."""
        width = WINDOW
        while start < len(self.text):
            stop = start + width
            end = start
            for piece in _cut(self.bpe, self.text[start:stop]):
                end += len(piece)
                if end > stop - ahead and stop < len(self.text):
                    break
                start = end
                yield piece
            else:
                return
            width *= 2

    def edit(self, at: int, removed: int, added: str) -> None:
        """Replace ``removed`` characters from ``at`` by ``added``; ranges beyond the text are cut off."""
        at = max(0, min(at, len(self.text)))
        removed = max(0, min(removed, len(self.text) - at))
        before, self.text = self.text, self.text[:at] + added + self.text[at + removed:]
        if not before:
            self.tree = self._built()
            self.recounted += self.tree.pieces
            return
        # a pre-token sees AHEAD characters behind it at most, or a mark there, so one that ends before that stays
        mark, ahead = max(map(len, self.bpe.special), default=0) + AHEAD, AHEAD
        if "<" in before[max(0, at - mark):at + removed] or "<" in added:
            ahead = mark
        leaf, place, start = self.tree.locate(max(0, at - ahead - 1))
        shift, old_end, old = len(added) - removed, start, 0
        behind = self.tree.from_place(leaf, place)
        fresh = self._pieces_from(start, mark)
        pieces, end = [], start
        while True:
            while old_end + shift < end or old_end < at + removed:
                step = next(behind, None)
                if step is None:
                    break
                old_end, old = old_end + step, old + 1
            if end >= len(self.text) or (old_end >= at + removed and old_end + shift == end):
                break
            piece = next(fresh)
            pieces.append(piece)
            end += len(piece)
        if end >= len(self.text):
            old += sum(1 for _ in behind)
        self.tree.replace(leaf, place, old, list(map(len, pieces)), self._counts(pieces))
        self.recounted += len(pieces)


def edit_counts(docs: DataFrame, path: str, edits_col: str = "edits", id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, tokens_before, tokens_after, n_pieces, n_recounted, text, lengths, counts) for each row.

    ``edits`` is an array of structs (at, removed, added), carried out in order,
    each on the text that the one before left; places and lengths are code
    points, cut off at the ends of the text. ``n_pieces`` counts the pre-tokens
    at the end, ``n_recounted`` those counted because of an edit; ``lengths``
    and ``counts`` (little-endian 32-bit integers) are the leaves of the tree.
    With columns ``lengths`` and ``counts`` in ``docs``, as an earlier run
    returned them, the tree is taken from there, and no text is encoded anew.

    A null text is an empty one; null edits, and an edit with a null place, do
    nothing; a null ``removed`` is 0, a null ``added`` empty. Null and repeated
    ids come back as they are. Other columns play no role. An empty table gives
    no rows.
    """
    prepared(docs.sparkSession)
    stored = {"lengths", "counts"} <= set(docs.columns)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.col(f"`{edits_col}`").cast("array<struct<at: long, removed: long, added: string>>").alias("edits"),
        *(F.col(c) if stored else F.lit(None).cast("binary").alias(c) for c in ("lengths", "counts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_trie.at(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = part.column("text").to_pylist()
                # the distinct words of all these texts in one walk
                cut = [_cut(bpe, t) if kept is None else None
                       for t, kept in zip(texts, part.column("counts").to_pylist())]
                words = set().union(*(pieces for pieces in cut if pieces))
                yield _edited(part, texts, cut, words, bpe)

    return rows.mapInArrow(run, f"{RESULT}, text string, lengths binary, counts binary")


def _edited(part: pa.RecordBatch, texts: list[str], cut: list[list[str] | None], words: set[str],
            bpe: bpe_trie.TrieBpe) -> pa.RecordBatch:
    _learn(bpe, words)
    # all trees first: counting an edit's words may clear what is remembered
    made = []
    for text, pieces, lengths, counts in zip(texts, cut, *(part.column(c).to_pylist() for c in ("lengths", "counts"))):
        tree = None
        if lengths is not None and counts is not None:
            tree = CountTree(*(np.frombuffer(x, "<i4").tolist() for x in (lengths, counts)))
        made.append(CountedText(text, bpe, tree, pieces))
    rows: list[tuple] = []
    for held, edits in zip(made, part.column("edits").to_pylist()):
        before = held.tree.total
        for edit in edits or []:
            if edit is not None and edit["at"] is not None:
                held.edit(edit["at"], edit["removed"] or 0, edit["added"] or "")
        leaves = [np.array([x for leaf in side for x in leaf], "<i4").tobytes()
                  for side in (held.tree.lengths, held.tree.counts)]
        rows.append((before, held.tree.total, held.tree.pieces, held.recounted, held.text, *leaves))
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
    names = ["tokens_before", "tokens_after", "n_pieces", "n_recounted", "text", "lengths", "counts"]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                      names=["doc_id", *names])
