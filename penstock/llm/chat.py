"""Conversations in reply order, by linking quotations; in Spark's own functions only.

Each line of a message has a quote level (the '>' marks before it). Lines in a
row at one level are a passage. A quoted passage, normalised and hashed, is
joined to the first earlier message of the conversation that says it itself; so
are its lines and sentences, for a passage quoted in part, wrapped anew or
answered piece by piece. The message replies to the latest of those it quotes
at the first level (or, if none of these is found, at any level). Replies form
trees, and a conversation is read tree by tree, in the order of the trees'
first messages. Only quoted lines whose original was found leave the body.

Nothing is gathered per conversation: one of any size is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm.store import prepared, written

SPACES = " \t\n\x0b\x0c\r"


#: Between the sentences of a normalised passage.
SENTENCE = r"(?<=[.!?…])\s+|(?<=[。！？])\s*"


def _lines(text: str = "text") -> F.Column:
    return F.split(F.coalesce(text, F.lit("")), "\r?\n")


def _normal(passage: F.Column) -> F.Column:
    return F.regexp_replace(F.lower(passage), r"\s+", " ")


def _sentences(passage: F.Column) -> F.Column:
    return F.filter(F.split(passage, SENTENCE), lambda x: x != "")


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, name, level, first, lines, passage): the runs of lines at one quote level, normalised; blank
    ones left out. ``name`` is a hash of the message's text, ``first`` the place of the first of the run's lines.

    The level of a line is the number of '>' before its text, each with any
    white space before it. A blank line ends a passage.
    """
    marked = F.transform(_lines(), lambda x: F.struct(
        (F.length(F.regexp_replace(F.regexp_extract(x, r"^((?:\s*>)*)", 1), r"\s", ""))).alias("level"),
        F.btrim(F.regexp_replace(x, r"^(?:\s*>)*", ""), F.lit(SPACES)).alias("line")))
    key = ["conv_id", "turn", "name"]
    rows = messages.select("conv_id", "turn", text_name().alias("name"), F.explode(F.array(marked)).alias("m"))
    # a run begins where the level changes or after a blank line
    starts = F.expr("""filter(sequence(0, size(m) - 1), i -> m[i].line <> '' AND
        (i = 0 OR m[i - 1].line = '' OR m[i - 1].level <> m[i].level))""")
    rows = rows.select(*key, "m", F.explode(F.array(starts)).alias("s"))
    rows = rows.select(*key, "m", F.posexplode("s").alias("k", "first"), F.col("s"))
    run = F.expr("""filter(slice(m, first + 1, coalesce(try_element_at(s, k + 2), size(m)) - first),
        x -> x.line <> '')""")
    rows = rows.select(*key, F.expr("m[first].level").alias("level"), "first",
                       F.explode(F.array(F.transform(run, lambda x: x["line"]))).alias("lines"))
    return rows.select(*key, "level", "first", F.transform("lines", _normal).alias("lines"),
                       _normal(F.array_join("lines", " ")).alias("passage"))


def text_name(text: str = "text") -> F.Column:
    """Tells the rows of a repeated turn apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _hashed(rows: DataFrame, column: str, *others: str) -> DataFrame:
    return rows.select(*others, F.xxhash64(column).alias("h1"), F.xxhash64(F.lit(1), column).alias("h2"))


def _units(found: DataFrame) -> DataFrame:
    """The quoted passages whole (line -1), their lines, and the sentences of both (``part``), each hashed."""
    def unit(line: F.Column, part: bool, words: F.Column) -> F.Column:
        return F.struct(line.cast("int").alias("line"), F.lit(part).alias("part"), words.alias("words"))

    whole = F.lit(-1)
    units = F.concat(
        F.array(unit(whole, False, F.col("passage"))),
        F.transform(_sentences(F.col("passage")), lambda x: unit(whole, True, x)),
        F.transform("lines", lambda x, i: unit(i, False, x)),
        F.flatten(F.transform("lines", lambda x, i: F.transform(_sentences(x), lambda y: unit(i, True, y)))))
    key = ["conv_id", "turn", "name", "level", "first"]
    rows = found.where("level > 0").select(*key, F.size("lines").alias("n"), F.xxhash64("passage").alias("p1"),
                                           F.xxhash64(F.lit(1), "passage").alias("p2"), F.explode(units).alias("u"))
    return _hashed(rows.select(*key, "n", "p1", "p2", "u.*"), "words", *key, "n", "p1", "p2", "line", "part")


def _said(found: DataFrame) -> DataFrame:
    """(conv_id, h1, h2, origin): the first message that says a passage, a line or a sentence itself; one row for
    each, so that a hot one is combined before the exchange."""
    units = F.array_distinct(F.concat(
        F.array("passage"), F.col("lines"), _sentences(F.col("passage")), F.flatten(F.transform("lines", _sentences))))
    rows = found.where("level = 0").select("conv_id", "turn", F.explode(units).alias("words"))
    return _hashed(rows, "words", "conv_id", "turn").groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("origin"))


def quotations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, name, level, p1, p2, origin, gone) for each quoted passage; ``gone`` are the places of those of
    its lines whose original was found, whole or sentence by sentence."""
    found = written(passages(messages), "passages")
    joined = _units(found).join(_said(found), ["conv_id", "h1", "h2"], "left") \
        .withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin")))
    key = ["conv_id", "turn", "name", "level", "first", "n", "p1", "p2"]
    # a hash stands once or more often: rows that repeat a turn with one text count once
    lines = joined.groupBy(*key, "line").agg(
        F.max(F.when(~F.col("part"), F.col("origin"))).alias("full"), F.max("origin").alias("any"),
        F.coalesce(F.bool_and(F.when(F.col("part"), F.col("origin").isNotNull())), F.lit(False)).alias("parts")) \
        .withColumn("linked", F.col("full").isNotNull() | F.col("parts"))
    whole = F.col("line") < 0
    some = F.collect_list(F.when(~whole & F.col("linked"), F.col("first") + F.col("line")))
    return lines.groupBy(*key).agg(
        F.coalesce(F.max(F.when(whole, F.col("full"))), F.max("full"), F.max("any")).alias("origin"),
        F.bool_or(whole & F.col("linked")).alias("all"), some.alias("some")) \
        .select(*key, "origin", F.when(F.col("all"), F.expr("sequence(first, first + n - 1)"))
                .otherwise(F.col("some")).alias("gone"))


def without(gone: str, text: str = "text") -> F.Column:
    """The text without the lines at the places ``gone``, blank lines at both ends removed."""
    lines = _lines(text)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    own = F.when(F.col(gone).isNull(), lines).otherwise(F.transform(left, lambda i: F.get(lines, i)))
    return F.regexp_replace(F.regexp_replace(F.array_join(own, "\n"), r"^(?:[ \t\x0B\f\r]*\n)+", ""), r"\s+$", "")


def reply_links(quoted: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, n_quotes, n_linked) for messages that quote; a passage quoted twice counts once."""
    distinct = quoted.groupBy("conv_id", "turn", "p1", "p2").agg(
        F.max("origin").alias("origin"), F.max(F.when(F.col("level") == 1, F.col("origin"))).alias("near"))
    return distinct.groupBy("conv_id", "turn").agg(
        F.coalesce(F.max("near"), F.max("origin")).alias("reply_to"),
        F.count("*").alias("n_quotes"), F.count("origin").alias("n_linked"))


def _roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread) for messages that reply: the first message of the tree, by doubling the steps."""
    at = written(links.where("reply_to IS NOT NULL").select("conv_id", "turn", F.col("reply_to").alias("thread")),
                 "replies")
    while True:
        up = at.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"))
        further = at.join(up, ["conv_id", "thread"], "left")
        if not further.where("further IS NOT NULL").limit(1).count():
            return at
        at = written(further.select("conv_id", "turn", F.coalesce("further", "thread").alias("thread")), "replies")


def chat(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, reply_to, thread, n_quotes, n_linked, body, formatted), in reply order.

    ``thread`` is the first turn of the message's tree; the order is conv_id,
    thread, turn, so a tree stands together and no reply before what it
    answers. ``n_quotes`` counts the quoted passages, ``n_linked`` those of which
    all, a line or a sentence was found. ``body`` is the text without the quoted
    lines that were found; one without an original, or quoted by a clause only,
    stays in it with its marks. ``formatted`` is the turn as ``<|role|>``, a
    line break, the body and a line break.

    A null text is an empty one, a null role ``unknown``. Rows with a null
    conv_id or turn reply to nothing and are read last of their group. Rows
    that repeat a turn are read side by side and answer alike. Other columns
    play no role. An empty table gives no rows.
    """
    prepared(messages.sparkSession)
    rows = messages.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
                           F.col(f"`{turn_col}`").cast("long").alias("turn"),
                           F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("unknown")).alias("role"),
                           F.col(f"`{text_col}`").cast("string").alias("text"))
    quoted = written(quotations(rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")), "quotations")
    links = written(reply_links(quoted), "reply-links")
    key = ["conv_id", "turn"]
    gone = quoted.groupBy(*key, "name").agg(F.flatten(F.collect_list("gone")).alias("gone"))
    out = rows.withColumn("name", text_name()).join(gone, [*key, "name"], "left") \
        .join(links, key, "left").join(_roots(links), key, "left") \
        .withColumn("thread", F.coalesce("thread", "turn")) \
        .withColumn("n_quotes", F.coalesce("n_quotes", F.lit(0))).withColumn("n_linked", F.coalesce("n_linked", F.lit(0)))
    out = out.withColumn("body", without("gone")).withColumn(
        "formatted", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("body"), F.lit("\n")))
    return out.select(*key, "role", "reply_to", "thread", "n_quotes", "n_linked", "body", "formatted") \
        .orderBy(F.col("conv_id").asc_nulls_last(), F.col("thread").asc_nulls_last(), "turn")
