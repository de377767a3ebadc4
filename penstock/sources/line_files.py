"""Closed log files as lines with their file's path. Growing files need :mod:`penstock.sources.tail`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, glob: str = "*.log", pattern: str | None = None,
               stream: bool = False, max_files: int | None = None) -> DataFrame:
    """Lines (``value``) and their ``file``; ``pattern`` must match the whole path."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if stream and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(path).select("value", F.col("_metadata.file_path").alias("file"))
    return lines if pattern is None else lines.where(F.col("file").rlike(f"^(?:{pattern})$"))
