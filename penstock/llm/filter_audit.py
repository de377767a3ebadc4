"""What five document filters remove, alone, together and in every order, by Hart and Mas-Colell's potential.

A document is the set of filters it fails. Of a part of the table only the
number of documents of each of the 32 sets matters, so the game "documents
removed by these filters" is known for all 32 coalitions from one small table.
The potential of a coalition follows from the coalitions one filter smaller,

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and a filter's Shapley value is P(all) less P(all but the filter). A step of an
order removes v(the filters so far) less v(the filters before).
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penstock.llm import text_bytes
from penstock.llm.store import prepared

FILTERS = "ABCDE"
#: Least words; least percent of distinct words; most percent of A-Z; characters that fail a document.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 50, 65, 5, b"#$%&*|"

_ALL = (1 << len(FILTERS)) - 1
_ORDERS = list(permutations(range(len(FILTERS))))
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


# ---------------------------------------------------------------- the filters

def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of ``flags`` each text has."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def failed_by_text(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D that each text of a slice fails."""
    count = len(offsets) - 1
    starts, ends, owner = text_bytes.words(data, offsets)
    n_words = np.bincount(owner, minlength=count)
    codes = text_bytes.range_hashes(data, starts, ends)
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    n_distinct = np.bincount(owner[new], minlength=count)
    points = _per_text((data & 0xC0) != 0x80, offsets)
    capitals = _per_text((data >= 0x41) & (data <= 0x5A), offsets)
    failed = [n_words < LEAST_WORDS, 100 * n_distinct < LEAST_DISTINCT * n_words,
              100 * capitals > MOST_CAPITALS * points, _per_text(_SYMBOL[data], offsets) > 0]
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    def run(texts: pa.Array) -> pa.Array:
        found = [failed_by_text(data, offsets) for _, _, data, offsets in text_bytes.slices(texts)]
        return pa.array(np.concatenate(found) if found else np.zeros(0, np.int32), pa.int32())

    return F.arrow_udf(run, "int")(text)


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, failed): the filters each row fails, as bits; ``docs`` has a column ``part``.

    E compares whole texts by their 256-bit digest over the whole table: first ids are taken per digest,
    combined before the exchange, and found again by id, so copies are never gathered.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       F.col("part"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    firsts = rows.where("doc_id IS NOT NULL").select("doc_id", digest).groupBy("digest") \
        .agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    thin = rows.select("doc_id", "part", text_failures(F.col("text")).alias("failed"), digest)
    known = thin.join(firsts, ["doc_id", "digest"], "left")
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return known.select("doc_id", "part", F.col("failed").bitwiseOR(copy).alias("failed"))


# ---------------------------------------------------------------- the game

def _removed(counts: np.ndarray) -> np.ndarray:
    """Documents that each coalition removes: those that fail at least one of its filters."""
    sets = np.arange(_ALL + 1)
    return ((sets[:, None] & sets[None, :]) != 0).astype(np.int64) @ counts


def potentials(value: np.ndarray) -> list[int]:
    """The potential of every coalition times the factorial of its size, which makes it whole.

    With Q(S) = |S|! P(S) the recursion reads Q(S) = (|S| - 1)! v(S) + sum of Q(S without i).
    """
    out = [0] * len(value)
    for coalition in range(1, len(value)):
        members = [1 << i for i in range(coalition.bit_length()) if coalition >> i & 1]
        out[coalition] = factorial(len(members) - 1) * int(value[coalition]) + sum(
            out[coalition ^ i] for i in members)
    return out


def shapley_sums(value: np.ndarray) -> list[int]:
    """Each player's marginal contribution, summed over all orders."""
    players = (len(value) - 1).bit_length()
    scaled = potentials(value)
    # n! (P(N) - P(N without i)), where the second is scaled by (n-1)!
    return [scaled[-1] - players * scaled[len(value) - 1 - (1 << i)] for i in range(players)]


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def _audited(part: str, counts: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> list[tuple]:
    total = int(counts.sum())
    value, of_good, of_toxic = (_removed(x).tolist() for x in (counts, good, toxic))
    shares = shapley_sums(np.array(value))
    out = []
    for order in _ORDERS:
        before, name = 0, "".join(FILTERS[i] for i in order)
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = value[after] - value[before]
            out.append((part, name, step, total - value[after], removed, value[1 << i] - removed,
                        value[_ALL] - value[_ALL ^ 1 << i], of_good[after] - of_good[before],
                        of_toxic[after] - of_toxic[before], shares[i]))
            before = after
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Rows (``AUDIT``) for each part, order of the five filters and step: 600 a part.

    Words are maximal ``[^\\x20\\x09-\\x0D]+``, case counts. A document fails A with under 50 words, B if distinct
    words are under 65 % of its words, C if A-Z are over 5 % of its code points, D with any of ``#$%&*|``, E if its
    text equals that of a smaller id anywhere in the table. All counts are of rows within the part: kept after the
    step, removed by it, redundant (failing its filter, removed before), unique_fails (failing its filter only),
    good_lost and toxic_lost (removed by it, labelled quality 1, toxic 1), shapley (its filter's removals summed over
    all orders).

    A null text is empty: it fails A, and E behind another empty one. A null part is the empty string. A row with a
    null id is compared with no other by E, and has no label. Rows that repeat an id count each; E takes
    equal ids as neither smaller. Where labels repeat an id, one that says 1 is enough; null labels say nothing.
    Other columns play no role. An empty table gives no rows.
    """
    prepared(docs.sparkSession)
    parted = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                         F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    marks = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), "quality", "toxic") \
        .where("doc_id IS NOT NULL").groupBy("doc_id").agg(
            F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    marked = failures(parted).join(marks, "doc_id", "left")
    counted = marked.groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))

    def audit(key: tuple, table: pa.Table) -> pa.Table:
        sums = np.zeros((3, _ALL + 1), np.int64)
        sums[:, table.column("failed").to_numpy()] = [table.column(c).to_numpy() for c in ("n", "good", "toxic")]
        columns = zip(*_audited(key[0].as_py(), *sums))
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=[field.split()[0] for field in AUDIT.split(", ")])

    # a part has 32 rows at most here
    return counted.groupBy("part").applyInArrow(audit, AUDIT)
