"""Counts and progress marks."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from penstock.operators import keyed
from penstock.sources import folders

PROGRESS_STEP = 10


def count_by(df: DataFrame, *group: str, marks_of: str | None = None, step: int = PROGRESS_STEP) -> DataFrame:
    """Rows per group and, if a running number is named, how many progress marks fall into it."""
    aggs = [F.count("*").alias("rows")]
    if marks_of:
        aggs.append(F.count_if(is_progress_mark(F.col(marks_of), step)).alias("marks"))
    return df.groupBy(*group).agg(*aggs)


def is_progress_mark(number: Column, step: int = PROGRESS_STEP) -> Column:
    """Every ``step``-th record by its 1-based running number."""
    return number % step == 0


def observed(df: DataFrame, name: str, ok: Column | None = None) -> tuple[DataFrame, Observation]:
    """The same batch frame with its row count taken on the way through, without a second pass."""
    observation = Observation(name)
    return df.observe(observation, *_metrics(ok)), observation


def observed_stream(df: DataFrame, name: str, ok: Column | None = None) -> DataFrame:
    """As :func:`observed` for a stream: the counts appear in each progress report under ``name``."""
    return df.observe(name, *_metrics(ok))


def _metrics(ok: Column | None) -> list[Column]:
    metrics = [F.count(F.lit(1)).alias("rows")]
    if ok is not None:
        metrics.append(F.count_if(ok).alias("ok_rows"))
    return metrics


#: Counts of one batch under one name; ``day`` is the folder they lie in.
COUNTS_SCHEMA = ("query string, batch long, at timestamp, name string, input_rows long, counts map<string, long>, "
                 "day string")


class CountKeeper(StreamingQueryListener):
    """Appends what :func:`observed_stream` counted to a table, batch by batch, while queries run.

    Each batch with input adds one small file to its day, which retention may remove; a batch without observed counts
    adds its number of input rows under an empty name. A report that cannot be written is kept in ``failed`` and stops
    no query.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.failed: list[tuple[str, int, Exception]] = []
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = {name: _longs(row.asDict()) for name, row in progress.observedMetrics.items()}
        if not progress.numInputRows and not any(any(counts.values()) for counts in seen.values()):
            return
        rows = [(str(progress.id), progress.batchId, progress.timestamp, name, progress.numInputRows, counts,
                 progress.timestamp[:10]) for name, counts in (seen or {"": {}}).items()]
        try:
            found = self.spark.createDataFrame(rows, COUNTS_SCHEMA.replace("timestamp", "string"))
            (found.withColumn("at", F.col("at").cast("timestamp")).coalesce(1)
             .write.mode("append").partitionBy("day").parquet(self.path))
        except Exception as error:  # noqa: BLE001 - whatever it is, it must not reach the queries' event queue
            self.failed.append((str(progress.id), progress.batchId, error))

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Whether all reports of a query that ended have been taken in."""
        return self._end_of(str(query.runId)).wait(seconds)


def _longs(counts: dict) -> dict[str, int]:
    return {k: int(v) for k, v in counts.items() if isinstance(v, int)}


@contextmanager
def kept_counts(spark: SparkSession, path: str) -> Iterator[CountKeeper]:
    """Counts of all queries that run inside go to the table below ``path``; one table takes counts of many sessions."""
    keeper = CountKeeper(spark, path)
    spark.streams.addListener(keeper)
    try:
        yield keeper
    finally:
        spark.streams.removeListener(keeper)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row per query, batch and name: the last report of a batch that ran more than once."""
    if not folders.child_folders(spark, path, "day="):
        return spark.createDataFrame([], COUNTS_SCHEMA)
    found = spark.read.schema(COUNTS_SCHEMA).parquet(path)
    return keyed.latest_per_key(found, ["query", "batch", "name"], ["at"])
