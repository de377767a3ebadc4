"""Tables written once to the shared folder, and the package sent to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from penstock.session import apply_runtime_conf, fresh_folder

_PACKAGE = Path(__file__).resolve().parent.parent
_sent_to: set[str] = set()


def prepared(spark: SparkSession) -> SparkSession:
    """Settings that results depend on; the package where Python workers can import it, installed there or not."""
    context = spark.sparkContext
    if context.applicationId not in _sent_to:
        handle, path = tempfile.mkstemp(prefix=f"{_PACKAGE.name}-", suffix=".zip")
        os.close(handle)
        with zipfile.ZipFile(path, "w") as archive:
            for source in sorted(_PACKAGE.rglob("*.py")):
                archive.write(source, source.relative_to(_PACKAGE.parent))
        context.addPyFile(path)
        _sent_to.add(context.applicationId)
    return apply_runtime_conf(spark)


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table below ``spark.checkpoint.dir``, read again."""
    spark = frame.sparkSession
    path = fresh_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")
