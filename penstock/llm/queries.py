"""The registered queries of this package: thin digests of what its operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.llm import (bpe_trie, chat, edit_counts, filter_audit, language, line_dedup, near_dup, ngram_join, packing,
                          quality, structure, topk, toxicity, word_ids)
from penstock.llm.store import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, pos, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents)),
common AS (
  SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.pos, l.line, c.key IS NOT NULL AND l.doc_id <> c.holder AS dropped
  FROM lines l LEFT JOIN common c ON l.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def remainder(modulus: int):
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = table(spark, sf_dir, "labels").where(remainder(5) != 0)
    scored = toxicity.toxicity(docs, toxicity.fitted(docs, learned))
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_BASE_FAILED, _RULE_FAILED = quality.verdict_sql()
_LIST = "[" + ", ".join(f"'{w}'" for w in quality.STOP_WORDS) + "]"
OP3_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)),
repeated AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM repeated GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_intersect(list_transform(words, lambda w: lower(w)), {_LIST})) AS n_stop_words,
    len(list_filter(words, lambda w: regexp_matches(w, '\pL'))) AS n_letter_words,
    coalesce(c.n_repeat_words, 0) AS n_repeat_words
  FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({_BASE_FAILED}) AS base_failed,
  NOT ({_BASE_FAILED}) AND NOT (n_words > 0 AND ({_RULE_FAILED})) AS kept
FROM counted
"""


def vocabulary(name: str) -> str:
    """Where a public vocabulary lies; the same on every executor."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op4_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_trie.encoded(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def quoting(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, quotes): every message, quoting earlier ones before its own text.

    The tables' messages quote nothing. Here each turn quotes one of the three before it, in turns all of
    it, its first line, its last sentence, or all of it wrapped anew, and every other one also, at the second
    level, the first line of the turn before that. ``quotes`` holds what was quoted (level, origin, passage);
    it is null where there is no such turn.
    """
    salt = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(24)).cast("int")
    rows = messages.select("conv_id", "turn", "role", "text", (salt % 4).alias("way"), (salt % 8 < 4).alias("deep"),
                           (F.col("turn") - 1 - (salt / 8).cast("int")).alias("at"))
    rows = rows.withColumn("at", F.when(F.col("at") < 0, F.col("turn") - 1).otherwise(F.col("at")))
    texts = messages.groupBy("conv_id", F.col("turn").alias("at")).agg(F.min("text").alias("said"))
    deeper = texts.select("conv_id", (F.col("at") + 1).alias("at"), F.substring_index("said", "\n", 1).alias("older"))
    joined = rows.join(texts, ["conv_id", "at"], "left").join(deeper, ["conv_id", "at"], "left")
    last = F.element_at(F.split("said", r"(?<=[.!?])\s+|\n"), -1)
    wrapped = F.regexp_replace(F.regexp_replace("said", r"\s+", " "), r"(.{30,60}?) ", "$1\n")
    passage = F.when(F.col("way") == 0, F.col("said")).when(F.col("way") == 1, F.substring_index("said", "\n", 1)) \
        .when(F.col("way") == 2, last).otherwise(wrapped)
    near = F.struct(F.lit(1).alias("level"), F.col("at").alias("origin"), passage.alias("passage"))
    far = F.when(F.col("deep"), F.struct(F.lit(2).alias("level"), (F.col("at") - 1).alias("origin"),
                                         F.col("older").alias("passage")))
    quotes = F.when(F.col("said").isNotNull(), F.filter(F.array(far, near), lambda x: x["passage"].isNotNull()))
    out = joined.select("conv_id", "turn", "role", "text", quotes.alias("quotes"))
    marked = F.array_join(F.transform("quotes", lambda x: F.regexp_replace(
        x["passage"], "(?m)^", F.when(x["level"] == 1, "> ").otherwise(">> "))), "\n")
    return out.withColumn("text", F.when(F.col("quotes").isNull(), F.col("text")).otherwise(
        F.concat_ws("\n\n", marked, F.col("text"))))


def op5_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose messages quote earlier ones, derived from the whole table."""
    return chat.chat(quoting(table(spark, sf_dir, "conversations")))


def op6_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of every document: a cut in its middle, its beginning repeated, a passage in capitals."""
    docs = table(spark, sf_dir, "documents").withColumn("size", F.length("text"))
    edits = F.expr("""array(
        struct(size div 2 AS at, 20 AS removed, '' AS added),
        struct(size div 4 AS at, 0 AS removed, substring(text, 1, 12) AS added),
        struct(size div 8 AS at, 10 AS removed, upper(substring(text, size div 8 + 1, 10)) AS added))""")
    out = edit_counts.edit_counts(docs.withColumn("edits", edits), vocabulary("byte_bpe_50k.json"))
    return out.select("doc_id", "tokens_before", "tokens_after", "n_pieces", "n_recounted",
                      F.sha2("text", 256).alias("text_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), word_ids.encoder(vocabulary("word_bpe_49k.json")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op8_vector_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP8_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i, len(v) AS n FROM usable),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.n = c.n AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 5
"""


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op10_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.languages(docs, language.fitted(docs.where(remainder(4) != 2)))
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op11_structure_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.repaired(structure.damaged(table(spark, sf_dir, "conversations")))


def op12_ngram_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op13_filter_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
worded AS (
  SELECT d.doc_id, d.part, d.text, d.doc_id > f.first AS e,
    list_filter(string_split_regex(d.text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM texts d JOIN firsts f ON d.text = f.text),
failing AS (
  SELECT doc_id, part, CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text)
         THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN e THEN 'E' ELSE '' END AS fails
  FROM worded),
counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE l.quality = 1) AS good,
    count(*) FILTER (WHERE l.toxic = 1) AS toxic
  FROM failing d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders)),
met AS (
  SELECT c.part, s.filter_order, s.step, s.own, c.n, c.good, c.toxic, contains(c.fails, s.own) AS hit,
    length(translate(c.fails, s.before, '')) < length(c.fails) AS gone, c.fails = s.own AS alone
  FROM counted c CROSS JOIN steps s),
stepped AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE alone), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE hit AND NOT gone), 0) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM stepped
"""


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_quality_rules": op3_quality_rules,
    "op4_bpe_trie": op4_bpe_trie,
    "op5_chat_quotes": op5_chat_quotes,
    "op6_edit_counts": op6_edit_counts,
    "op7_packing": op7_packing,
    "op8_vector_files": op8_vector_files,
    "op9_near_dup": op9_near_dup,
    "op10_language_filters": op10_language_filters,
    "op11_structure_audit": op11_structure_audit,
    "op12_ngram_tries": op12_ngram_tries,
    "op13_filter_potential": op13_filter_potential,
}

ORACLE = {
    "op1_line_dedup": OP1_SQL,
    "op3_quality_rules": OP3_SQL,
    "op8_vector_files": OP8_SQL,
    "op13_filter_potential": OP13_SQL,
}


def registered() -> dict:
    """These queries and the pipeline at the top of the repository."""
    import corpus_pipeline
    return QUERIES | {"pipeline": corpus_pipeline.run}
