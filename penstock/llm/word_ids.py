"""Token ids of a word-end BPE vocabulary, for whole texts at the speed of word look-ups.

Words between white space do not act on each other in this kind of vocabulary,
so a text's ids are the ids of its pre-tokens in a row. These are found in numpy
for a slice of texts at once and hashed; only distinct ones are looked up in a
table of bounded size, and their ids are taken by number for the whole slice.
New ones are merged together, one merge of every one per step. A text with a
character outside the ranges below, or with the mark of a special token, is
left whole to the tokenizers library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np

from penstock.llm import text_bytes

#: Characters worked on at once; longer texts are cut at white space.
SLICE = 1 << 20
#: Pre-tokens remembered by a task; beyond it the table starts anew.
REMEMBERED = 1_000_000
#: Letters, digits, signs and white space on which this module and the library agree; tests compare all of them.
_OTHER = re.compile("[^\\x00-\\x1b\\x20-\\x7e¡-¬®-±´-¸º»¿-įĲ-ň"
                    "Ŋ-ž‐-‧]|<\\|")
_ODD_ASCII = "\x1c\x1d\x1e\x1f\x7f"
#: Endings that are one pre-token with the apostrophe before them: fixed values of this kind of vocabulary.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_SPACE, _LETTER, _DIGIT, _SIGN = range(4)


def _kind(character: str) -> int:
    if character.isspace():
        return _SPACE
    if character.isdigit():
        return _DIGIT
    return _LETTER if re.match(r"[^\W_]", character) else _SIGN


#: The kind of each character up to the last that ``_OTHER`` leaves.
_KINDS = np.array([_kind(chr(c)) for c in range(0x2028)], np.uint8)


def pre_tokens(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First characters, and those after the last, of the pre-tokens of lower-cased text: runs of letters, single
    digits, runs of signs, and endings with their apostrophe."""
    kind = np.concatenate([_KINDS[codes], np.zeros(4, np.uint8)])
    codes = np.concatenate([codes, np.zeros(4, codes.dtype)])
    begins = (kind != _SPACE) & (kind == _DIGIT)
    begins[0] |= kind[0] != _SPACE
    begins[1:] |= (kind[1:] != _SPACE) & (kind[1:] != kind[:-1])
    marks = np.flatnonzero(begins & (codes == 0x27))
    for ending in _ENDINGS:
        hit = np.ones(len(marks), bool)
        for i, letter in enumerate(ending, 1):
            hit &= codes[marks + i] == ord(letter)
        at = marks[hit]
        begins[at + 1] = False
        after = at + 1 + len(ending)
        begins[after] = kind[after] != _SPACE
        marks = marks[~hit]
    ends = (kind[:-1] != _SPACE) & (begins[1:] | (kind[1:] == _SPACE))
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairTable:
    """Rank and result of each mergeable pair of ids, looked up for many pairs at once."""

    def __init__(self, pairs: np.ndarray, results: np.ndarray) -> None:
        self.mask = (1 << max(4, int(len(pairs) * 4).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.at = np.full(self.mask + 1, -1, np.int32)
        keys = (pairs[:, 0].astype(np.int64) << 32) | pairs[:, 1]
        left, slot, self.steps = np.arange(len(keys)), self._slot(keys), 0
        while len(left):
            free = self.keys[slot] == -1
            first = np.unique(slot[free], return_index=True)[1]
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]] = keys[left[put]]
            self.at[slot[put]] = left[put]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask
            self.steps += 1
        self.results = results.astype(np.int32)
        self.none = np.int32(len(results))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & self.mask

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, or ``none``."""
        keys = (a.astype(np.int64) << 32) | b
        slot = self._slot(keys)
        there = self.keys[slot]
        found = np.where(there == keys, self.at[slot], self.none)
        open_ = np.flatnonzero((there != keys) & (there != -1))
        for _ in range(self.steps):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.at[slot[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return found


def merged(symbols: np.ndarray, table: PairTable) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their ids) for words of equal length, a row each: the lowest rank, leftmost first, is merged."""
    rows, done = np.arange(len(symbols)), []
    ranks = table.ranks(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(len(symbols), -1)
    while symbols.shape[1] > 1 and len(rows):
        best = ranks.argmin(axis=1)
        lowest = ranks[np.arange(len(rows)), best]
        ended = lowest == table.none
        if ended.any():
            done.append((rows[ended], symbols[ended]))
            go = ~ended
            rows, symbols, ranks, best, lowest = rows[go], symbols[go], ranks[go], best[go], lowest[go]
            if not len(rows):
                return done
        each, width = np.arange(len(rows)), symbols.shape[1]
        symbols[each, best] = table.results[lowest]
        keep = np.ones(symbols.shape, bool)
        keep[each, best + 1] = False
        symbols = symbols[keep].reshape(len(rows), width - 1)
        keep = np.ones(ranks.shape, bool)
        keep[each, best] = False
        ranks = ranks[keep].reshape(len(rows), width - 2)
        left = np.flatnonzero(best > 0)
        if len(left):
            at = best[left] - 1
            ranks[left, at] = table.ranks(symbols[left, at], symbols[left, at + 1])
        right = np.flatnonzero(best < width - 2)
        if len(right):
            at = best[right]
            ranks[right, at] = table.ranks(symbols[right, at], symbols[right, at + 1])
    if len(rows):
        done.append((rows, symbols))
    return done


def _parts(text: str) -> Iterator[str]:
    """A long text cut after white space."""
    blank = re.compile(r"\s")
    at = 0
    while at < len(text):
        found = blank.search(text, at + SLICE)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end


class WordIds:
    """Ids of texts under a word-end BPE vocabulary of the tokenizers library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.final = np.array([vocab[x + end] for x in letters], np.int32)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.table = PairTable(np.array([(vocab[a], vocab[b]) for a, b in merges], np.int64),
                               np.array([vocab[a + b] for a, b in merges]))
        self._forget()

    def _forget(self) -> None:
        """An empty table: the number of each known pre-token by its hash, and the ids of all of them in a row."""
        self.known: dict[int, int] = {}
        self.begin, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _learn(self, codes: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of new pre-tokens, given by their hashes and bytes."""
        self.known.update(zip(codes.tolist(), range(len(self.length), len(self.length) + len(codes))))
        found = []
        for size in np.unique(sizes).tolist():
            which = np.flatnonzero(sizes == size)
            raw = data[starts[which][:, None] + np.arange(size)]
            symbols = self.inner[raw]
            symbols[:, -1] = self.final[raw[:, -1]]
            found += [(which[rows], ids) for rows, ids in merged(symbols, self.table)]
        lengths = np.zeros(len(codes), np.int64)
        for which, ids in found:
            lengths[which] = ids.shape[1]
        begin = np.cumsum(lengths) - lengths
        flat = np.zeros(int(lengths.sum()), "<u4")
        for which, ids in found:
            flat[begin[which][:, None] + np.arange(ids.shape[1])] = ids
        self.begin = np.concatenate([self.begin, len(self.ids) + begin])
        self.length = np.concatenate([self.length, lengths])
        self.ids = np.concatenate([self.ids, flat])

    def _numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each byte range in the table; unknown ones are learned."""
        distinct, first, which = np.unique(text_bytes.range_hashes(data, starts, ends), return_index=True,
                                           return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        get = self.known.get
        numbers = np.fromiter([get(key, -1) for key in distinct.tolist()], np.int64, len(distinct))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = len(self.length) + np.arange(len(new))
            self._learn(distinct[new], data, starts[first[new]], (ends - starts)[first[new]])
        return numbers[which]

    def _slice(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that hold plain characters only."""
        joined = "\n".join(texts).lower()  # each of these characters has one lower case, as many bytes long
        codes = np.frombuffer(joined.encode("utf-16-le"), "<u2")
        starts, ends = pre_tokens(codes)
        place = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int64))])
        numbers = self._numbers(np.frombuffer(joined.encode(), np.uint8), place[starts], place[ends])
        lengths = self.length[numbers]
        after = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.arange(after[-1]) + np.repeat(self.begin[numbers] - after[:-1], lengths)]
        edges = np.cumsum([0, *(len(text) + 1 for text in texts)])
        cuts = after[np.searchsorted(starts, edges)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _plain_ids(self, texts: list[str]) -> Iterator[bytes]:
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > SLICE:
                yield from self._slice(held)
                held, size = [], 0
            if len(text) > SLICE:
                yield b"".join(self._slice([part])[0] for part in _parts(text))
            else:
                held.append(text)
                size += len(text)
        if held:
            yield from self._slice(held)

    @staticmethod
    def _plain(text: str) -> bool:
        if text.isascii():
            return "<|" not in text and not any(x in text for x in _ODD_ASCII)
        return not _OTHER.search(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        plain = [self._plain(text) for text in texts]
        found = self._plain_ids([text for text, whole in zip(texts, plain) if whole])
        return [next(found) if whole else
                np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                for text, whole in zip(texts, plain)]


def encoder(path: str) -> Callable[[], Callable[[list[str]], list[bytes]]]:
    """For ``packing.pack``: makes the encoder where the task runs; a worker that goes on to other tasks keeps it."""
    def make() -> Callable[[list[str]], list[bytes]]:
        if path not in _made:
            _made[path] = WordIds(path)
        return _made[path].encode
    return make


_made: dict[str, WordIds] = {}
