"""Delimited text: tab-separated config exports and pipe-separated rows, always with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Neither form quotes or escapes, so a cell is what stands between separators.
_PLAIN = {"quote": "", "escape": "", "nullValue": "", "emptyValue": "", "encoding": "UTF-8"}


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab-separated file with a header line; an empty cell is NULL and keeps its place."""
    return spark.read.csv(path, schema=schema, sep="\t", header=True, enforceSchema=True, **_PLAIN)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.options(**_PLAIN).csv(path, sep="\t", header=True)


def read_pipe(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Pipe-separated rows without a header."""
    return spark.read.csv(path, schema=schema, sep="|", header=False, **_PLAIN)


def write_pipe(df: DataFrame, path: str) -> None:
    df.write.options(**_PLAIN).csv(path, sep="|", header=False)
