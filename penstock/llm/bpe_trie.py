"""Byte-level BPE encoding by a walk over the trie of a batch's distinct words.

The BPE encoding of a word ends in one token, and what stands before that token
is the encoding of the shorter prefix. So the state of a prefix is its last
token alone: the longest vocabulary entry that ends the prefix and that merging
would not have joined differently with the last token before it. Sorted words
are their trie in depth-first order: a word keeps the states of the prefix that
it shares with the one before, so shared prefixes are worked out once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm.store import prepared
from penstock.llm.word_ids import byte_letters

#: Words, and pairs of tokens, remembered by a task; beyond it the table starts anew.
REMEMBERED = 800_000
#: Characters outside the ranges on which the pattern below and the library's agree; tests compare all of them.
UNUSUAL = re.compile("[^\\x00-\\x1b\\x20-\\x7e¡-±´-¸º»¿-ɏ‐-‧€]")
# Fixed value: the pattern of byte-level vocabularies, in the terms of ``re``, for texts without unusual characters.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class TrieBpe:
    """A byte-level vocabulary of the tokenizers library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model = stored["model"]
        self.byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocab = {bytes(map(self.byte_of.__getitem__, token)): number for token, number in model["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in stored["added_tokens"]}
        self.number = {token: n for token, n in vocab.items() if token.decode("latin1") not in self.special}
        self.token = {n: token for token, n in vocab.items()} | {n: x.encode() for x, n in self.special.items()}
        self.size = {n: len(token) for n, token in self.token.items()}
        self.longest = max(map(len, self.number))
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        as_number = model["vocab"]
        self.merge = {(as_number[a], as_number[b]): (rank, as_number[a + b]) for rank, (a, b) in enumerate(merges)}
        self.single = [vocab[bytes([b])] for b in range(256)]
        self.parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str | bytes, bytes] = {}

    # ------------------------------------------------------------ states of prefixes

    def _merged(self, data: bytes) -> list[int]:
        """The encoding of a few bytes, one merge after the other."""
        ids = [self.single[b] for b in data]
        while True:
            best = min(((self.merge[pair][0], i) for i, pair in enumerate(zip(ids, ids[1:])) if pair in self.merge),
                       default=None)
            if best is None:
                return ids
            i = best[1]
            ids[i:i + 2] = [self.merge[ids[i], ids[i + 1]][1]]

    def _fit(self, before: int, token: int) -> bool:
        """Merging the two tokens' bytes gives these two again; ``before`` -1: the token's bytes give the token."""
        joined = (self.token[before] if before >= 0 else b"") + self.token[token]
        found = self._merged(joined) == ([before, token] if before >= 0 else [token])
        if len(self.fits) > REMEMBERED:
            self.fits.clear()
        self.fits[before, token] = found
        return found

    def walked(self, words: list[bytes]) -> Iterator[bytes]:
        """The ids of each of the sorted words, as little-endian unsigned 32-bit integers."""
        number, fits, size, longest = self.number.get, self.fits, self.size, self.longest
        last: list[int] = []  # the last token of the word's first 1, 2, ... bytes
        before = b""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared:]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = number(word[start:end])
                    if token is None:
                        continue
                    pair = (last[start - 1] if start else -1, token)
                    fit = fits.get(pair)
                    if fit or (fit is None and self._fit(*pair)):
                        last.append(token)
                        break
            before = word
            ids, end = [], len(word)
            while end:
                ids.append(last[end - 1])
                end -= size[last[end - 1]]
            yield np.array(ids[::-1], "<u4").tobytes()

    def learn(self, words: Iterable[str | bytes]) -> None:
        """Remember the ids of words that are not known yet."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = [w for w in words if w not in self.known]
        raw = {w: w.encode() if isinstance(w, str) else w for w in new}
        ordered = sorted(set(raw.values()))
        ids = dict(zip(ordered, self.walked(ordered)))
        self.known.update((w, ids[b]) for w, b in raw.items())

    # ------------------------------------------------------------ texts

    def pieces(self, text: str) -> list[str] | list[bytes]:
        """The pre-tokens of a text without special tokens; as bytes where the library had to cut it."""
        if not UNUSUAL.search(text):
            return PIECE.findall(text)
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in self.cutter.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = []
        for text in texts:
            parts = [text] if self.parts is None or "<" not in text else self.parts.split(text)
            cut.append([part if part in self.special else self.pieces(part) for part in parts])
        self.learn(set().union(*(part for parts in cut for part in parts if isinstance(part, list))))
        get = self.known.__getitem__
        return [b"".join([np.array([self.special[part]], "<u4").tobytes() if isinstance(part, str) else
                          b"".join(map(get, part)) for part in parts]) for parts in cut]

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens as they are written; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_made: dict[str, TrieBpe] = {}


def at(path: str) -> TrieBpe:
    """The vocabulary of a file; a worker that goes on to other tasks keeps it."""
    if path not in _made:
        _made[path] = TrieBpe(path)
    return _made[path]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for each row: ids as little-endian unsigned 32-bit integers.

    ``path`` names the vocabulary on every executor. A null text is an empty
    one and has no ids. Null and repeated ids come back as they are. Other
    columns play no role. An empty table gives no rows.
    """
    prepared(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = at(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                ids = bpe.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
