"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before it kept, as a table, and
returns documents again; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from penstock.llm import language, line_dedup, near_dup, packing, queries, toxicity, word_ids
from penstock.llm.store import table, written

#: A document goes if less than this share of its n-grams belongs to its likeliest language.
LEAST_LANGUAGE = 0.2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; it learns from the labelled ones that are not held back.

    Null and empty texts score low and stay, as do rows with a null id; repeated rows share their fate. Without
    labels of both kinds everything scores alike, and low, so all stay. An empty table stays empty.
    """
    learned = table(spark, sf_dir, "labels").where(queries.remainder(5) != 0)
    model = toxicity.fitted(docs, learned)
    return docs.where(toxicity.scores(spark, model)(F.col("text")) < 0.5)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that occur; those without letters, or like none of them, go.

    So null and empty texts go; a null id changes nothing, repeated rows share their fate, ties between
    languages go to the first by name. An empty table stays empty.
    """
    filters = language.fitted(docs.where(queries.remainder(4) != 2))
    found = language.predictions(spark, filters)(F.col("text"))
    kept = docs.withColumn("__found", found).where(
        (F.col("__found.lang_pred") != language.UNKNOWN) & (F.col("__found.score") >= LEAST_LANGUAGE))
    return kept.drop("__found")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents; lines that at least three hold stay only in the last of these.

    A null text comes back empty; a row with a null id keeps its lines and counts for none; rows that repeat an id
    count once. ``n_chars`` follows the text. An empty table stays empty.
    """
    return line_dedup.line_dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near duplicates, one row of each.

    Empty texts are near to nothing and stay. Of rows that repeat an id, the one whose text comes first stays. Rows with
    a null id are compared with each other by equal text only. An empty table stays empty.
    """
    found = near_dup.near_duplicates(docs)
    kept = docs.join(found.where("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__id"))
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    rank = F.row_number().over(Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
                               .orderBy("text"))
    several = kept.join(repeated, same, "left_semi").withColumn("__rank", rank).where("__rank = 1").drop("__rank")
    return kept.join(repeated, same, "left_anti").unionByName(several)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with their token ids.

    A null or empty text is its end id alone; repeated rows and rows with a null id are packed each on its own. An empty
    table gives no pieces.
    """
    return packing.pack(docs, word_ids.encoder(queries.vocabulary("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dup", drop_near_duplicates),
    ("packing", pack),
]

#: Classifiers and a similarity join have no SQL; tests hold the stages against brute force or held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
