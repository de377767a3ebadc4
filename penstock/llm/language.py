"""Language identification with language-bitmask n-gram filters.

One Bloom filter per language, stored bit-sliced: a slot holds one bit for each
language, so that the words at an n-gram's slots, ANDed, give at once all
languages whose filter contains it. A text's n-grams are counted per language
by those bits; each count is corrected by what a filter as full as that one
answers by chance, and the language with the highest share decides.

The filters hold the n-grams that are frequent in a language's training texts
and not much more frequent in another's, so a few foreign passages in them add
nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.llm import grams, text_bytes
from penstock.llm.store import prepared

GRAMS = (1, 2, 3, 4)
UNKNOWN = "und"
UNIT = 1 << 32
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the training.

    ``rows``: labelled rows learned from, about this many of each language at
    most, drawn by a hash of the id. An n-gram code enters a language's filter if it
    makes up at least one in ``rarest`` of the language's n-grams and no other
    language has it ``rival`` times as often.
    """

    rows: int = 1_500
    codes: int = 1 << 18
    rarest: int = 20_000
    rival: float = 3.0
    slots: int = 1 << 18
    hashes: int = 3
    seed: int = 5


@dataclass(frozen=True)
class Filters:
    """``table[slot, w]`` holds the bits of languages 64 w to 64 w + 63."""

    languages: list[str]
    table: np.ndarray
    codes: int
    hashes: int

    def chance(self) -> np.ndarray:
        """How often each language's filter contains an n-gram that was not put in."""
        return np.array([self._bits(self.table, k).mean() ** self.hashes for k in range(len(self.languages))])

    @staticmethod
    def _bits(words: np.ndarray, language: int) -> np.ndarray:
        return (words[:, language // 64] >> np.uint64(language % 64)) & np.uint64(1)

    def containing(self, codes: np.ndarray) -> np.ndarray:
        """The languages of each n-gram code, as bits."""
        found = self.table[_slot(codes, 0, len(self.table))]
        for k in range(1, self.hashes):
            found = found & self.table[_slot(codes, k, len(self.table))]
        return found

    def shares(self, data: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The corrected share of each text's n-grams that each language contains; 0 without n-grams.

        ``known`` is ``containing`` of every code.
        """
        text, places, owner = grams.normalised(data, offsets)
        count = len(offsets) - 1
        total, hits = np.zeros(count), np.zeros((count, len(self.languages)))
        first = np.append(places, len(text))[np.searchsorted(owner, np.arange(count + 1))]
        for at, codes in grams.hashed(text, GRAMS):
            edges = np.searchsorted(at, first)
            total += edges[1:] - edges[:-1]
            found = known[codes & np.uint32(self.codes - 1)]
            for k in range(len(self.languages)):
                sums = np.concatenate([[0], np.cumsum(self._bits(found, k), dtype=np.int64)])
                hits[:, k] += sums[edges[1:]] - sums[edges[:-1]]
        chance = self.chance()
        share = hits / np.maximum(total, 1)[:, None]
        return np.clip((share - chance) / np.maximum(1 - chance, 1e-9), 0, 1)


def _slot(codes: np.ndarray, number: int, slots: int) -> np.ndarray:
    mixed = text_bytes.mixed(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (number + 1) % 2**64))
    return (mixed % np.uint64(slots)).astype(np.int64)


def built(languages: list[str], counts: np.ndarray, fit: Fit) -> Filters:
    """Filters from the count of each n-gram code (columns) in each language (rows)."""
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    top = share.max(axis=0) if len(languages) else np.zeros(fit.codes)
    table = np.zeros((fit.slots, max(1, -(-len(languages) // 64))), np.uint64)
    for k in range(len(languages)):
        member = np.flatnonzero((share[k] * fit.rarest >= 1) & (share[k] * fit.rival >= top))
        for number in range(fit.hashes):
            slots = np.unique(_slot(member.astype(np.uint32), number, fit.slots))
            table[slots, k // 64] |= np.uint64(1) << np.uint64(k % 64)
    return Filters(languages, table, fit.codes, fit.hashes)


def gram_counts(rows: DataFrame, codes: int) -> DataFrame:
    """(lang, code, count) over ``rows(lang, text)``: counted per task, then summed.

    The n-grams of one length count ``UNIT`` together in each text, so that a long text weighs as much as a short one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for first, last, data, offsets in text_bytes.slices(batch.column("text")):
                text, places, owner = grams.normalised(data, offsets)
                if not len(owner):
                    continue
                of_byte = np.repeat(owner, np.diff(np.append(places, len(text))))
                part = langs[first:last]
                found = [(of_byte[at], code) for at, code in grams.hashed(text, GRAMS)]
                weights = [UNIT // np.maximum(np.bincount(doc, minlength=last - first), 1) for doc, _ in found]
                for lang in set(part):
                    mine = part == lang
                    total = held.setdefault(lang, np.zeros(codes, np.int64))
                    for (doc, code), weight in zip(found, weights):
                        chosen = mine[doc]
                        total += np.bincount(code[chosen] & np.uint32(codes - 1), weight[doc[chosen]], codes) \
                            .astype(np.int64)
        for lang, total in held.items():
            code = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code),
                                              pa.array(total[code])], names=["lang", "code", "count"])

    return rows.select("lang", "text").mapInArrow(run, "lang string, code long, count long") \
        .groupBy("lang", "code").agg(F.sum("count").alias("count"))


def fitted(docs: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang") -> Filters:
    """Filters from the rows of ``docs`` with an id, a text and a language; the caller leaves out those held back.

    The driver gets at most ``codes`` counts of each language that occurs.
    Without any such row there are no languages and every text is ``und``.
    """
    prepared(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{lang_col}`").alias("lang"),
                       F.col(f"`{text_col}`").alias("text")).where("id IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    share = F.lit(0.0)
    for lang, size in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, fit.rows / size)).otherwise(share)
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(fit.seed), "id"), F.lit(1 << 30)) < share * (1 << 30)) \
        .where("text IS NOT NULL")
    counts = np.zeros((len(languages), fit.codes))
    for lang, part in gram_counts(drawn, fit.codes).toPandas().groupby("lang"):
        counts[languages.index(lang), part["code"]] = part["count"]
    return built(languages, counts, fit)


def predictions(spark: SparkSession, filters: Filters) -> Callable[[Column], Column]:
    """A function from a column of texts to structs (lang_pred, score)."""
    sent = prepared(spark).sparkContext.broadcast(filters)  # fixed size: slots times languages

    def predict(texts: pa.Array) -> pa.Array:
        names = np.array([*sent.value.languages, UNKNOWN], dtype=object)
        known = sent.value.containing(np.arange(sent.value.codes, dtype=np.uint32))
        best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
        for _, _, data, offsets in text_bytes.slices(texts):
            raw = data.tobytes()
            letters = np.array([bool(_LETTER.search(raw[a:b].decode("utf-8", "replace")))
                                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            if len(names) == 1:
                letters[:] = False
            share = sent.value.shares(data, offsets, known) if len(names) > 1 else np.zeros((len(letters), 1))
            best.append(np.where(letters, share.argmax(axis=1), len(names) - 1))
            score.append(np.where(letters, share.max(axis=1), 0.0))
        return pa.StructArray.from_arrays(
            [pa.array(names[np.concatenate(best)].tolist(), pa.string()), pa.array(np.concatenate(score))],
            names=["lang_pred", "score"])

    return F.arrow_udf(predict, "lang_pred string, score double")


def languages(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for each row; score is the corrected share of the n-grams of lang_pred.

    ``und`` with score 0 if the text is null, has no letter, or no language was
    learned. Ties go to the first language in order. Null and repeated ids come
    back as they are. Other columns play no role. An empty table gives no rows.
    """
    found = predictions(docs.sparkSession, filters)(F.col(f"`{text_col}`").cast("string"))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), found.alias("found")) \
        .select("doc_id", "found.*")
