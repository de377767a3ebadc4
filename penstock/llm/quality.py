"""Quality rules: a table of thresholds compiled into one projection, in Spark's own functions only.

The statistics of a text are computed within its row: nothing is exploded,
grouped or exchanged, however long a text or frequent a word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penstock.llm.store import prepared

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of four languages.
STOP_WORDS = (
    "the of and to in is that it for with as on be at by this from or was are "
    "de la le les des et en un une du que qui pour dans par est au sur pas "
    "der die das und den von zu mit ist im dem nicht ein eine als auch auf für sich "
    "el los las del se por con para su al lo y es una"
).split()


@dataclass(frozen=True)
class Rule:
    """A statistic, as SQL over the columns of ``measured``, and the range it must lie in (either end open)."""

    name: str
    statistic: str
    least: float | None = None
    most: float | None = None

    def failed(self) -> str:
        tests = [f"({self.statistic}) < {self.least}"] * (self.least is not None)
        tests += [f"({self.statistic}) > {self.most}"] * (self.most is not None)
        return " OR ".join(tests)


BASE = (
    Rule("words", "n_words", least=50),
    Rule("repeated words in percent", "100 * n_repeat_words - 50 * n_words", most=0),
)
RULES = (
    Rule("code points per word", "1.0 * word_chars / n_words", least=2, most=12),
    Rule("symbols per word", "1.0 * n_symbols / n_words", most=0.2),
    Rule("stop words", "n_stop_words", least=2),
    Rule("share of repeated lines", "1.0 * n_dup_lines / n_lines", most=0.5),
    Rule("share of words with a letter", "1.0 * n_letter_words / n_words", least=0.6),
)


def _once(frame: DataFrame, name: str, value: Column, *kept: str) -> DataFrame:
    """``value`` as a column that is computed once per row, however often it is used: a generator is not inlined."""
    return frame.select(*kept, F.explode(F.array(value)).alias(name))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with all statistics the rules name."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = _once(rows, "x", F.struct("words", lines.alias("lines")), "doc_id", "text")
    windows = F.expr("""CASE WHEN size(x.words) < 3 THEN array() ELSE
        transform(sequence(0, size(x.words) - 3), i -> xxhash64(x.words[i], x.words[i + 1], x.words[i + 2])) END""")
    stops = F.array(*[F.lit(w) for w in STOP_WORDS])
    rows = _once(rows, "y", F.struct(
        F.size("x.words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("x.lines").cast("long").alias("n_lines"),
        (F.size("x.lines") - F.size(F.array_distinct("x.lines"))).cast("long").alias("n_dup_lines"),
        # distinct words first: an intersection looks each up in a set
        F.size(F.array_intersect(F.transform("x.words", lambda w: F.lower(w)), stops)).cast("long")
        .alias("n_stop_words"),
        F.size(F.filter("x.words", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        windows.alias("windows")), "doc_id")
    rows = rows.select("doc_id", "y.*")
    # windows with an equal one: sorted with their places, equal ones stand side by side
    ordered = F.expr("""array_sort(transform(windows, (h, i) -> struct(h, i)))""")
    repeats = _once(rows, "z", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ordered),
                    *[c for c in rows.columns])
    places = F.expr("""array_sort(transform(filter(z, (w, k) -> (k > 0 AND z[k - 1].h = w.h)
        OR (k < size(z) - 1 AND z[k + 1].h = w.h)), w -> w.i))""")
    covered = _once(repeats, "p", F.when(F.col("z").isNotNull(), places), *[c for c in rows.columns])
    count = F.expr("""coalesce(aggregate(p, struct(0L AS n, -1 AS upto), (a, i) -> struct(
        a.n + (i + 3) - greatest(i, a.upto) AS n, i + 3 AS upto), a -> a.n), 0L)""")
    return covered.withColumn("n_repeat_words", count).drop("windows", "p")


def quality(docs: DataFrame, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """The statistics of each row, base_failed, kept, and the names of the failed rules.

    base_failed tells that a rule of ``base`` fails; kept that none of ``base``
    and ``rules`` does. Without words no rule of ``rules`` is asked.

    A null text has no words, as an empty one. Null and repeated ids come back
    as they are. Other columns play no role. An empty table gives no rows.
    """
    prepared(docs.sparkSession)
    failed = [F.when(F.expr(rule.failed()), F.lit(rule.name)) for rule in rules]
    out = measured(docs, id_col, text_col)
    out = out.withColumn("base_failed", F.expr(" OR ".join(rule.failed() for rule in base)))
    out = out.withColumn("failed", F.when(F.col("n_words") > 0, F.array_compact(F.array(*failed)))
                         .otherwise(F.array().cast("array<string>")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def verdict_sql(base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> tuple[str, str]:
    """The conditions for base_failed and for a failed further rule, as SQL."""
    return " OR ".join(r.failed() for r in base), " OR ".join(r.failed() for r in rules)
