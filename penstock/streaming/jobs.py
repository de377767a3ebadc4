"""The streaming jobs: device reports, keyed log table, daily archive, queue forwarding.

All are append-mode and stateless: no watermark, no shuffle before the sink
except the keyed table's one exchange. Progress lives in each query's
checkpoint, so a restart goes on where the last finished batch ended.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from penstock import session
from penstock.functions import device, logs
from penstock.operators import counters, lake
from penstock.sources import folders, kafka, tail
from penstock.streaming import rolling
from penstock.streaming.lake_table import LakeTable

# Commit interval and roll limits.
COMMIT_INTERVAL = "5 seconds"
ROLL_INTERVAL = "30 minutes"
ROLL_BYTES = rolling.ROLL_BYTES
DAY_COLUMN = "load_date"


def _started(writer: DataStreamWriter, checkpoint: str, interval: str | None, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if not once:
        return writer.trigger(processingTime=interval).start()
    old_goals = None
    while True:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        # A source that doesn't know this trigger takes one batch, which its cap may have cut: ask it again, and once
        # more where the goals that it has reached now were set by an earlier run.
        begun, ended = _levels(query)
        old_goals = not begun if old_goals is None else old_goals
        if ended and not old_goals:
            return query
        old_goals = old_goals and not ended


def _levels(query: StreamingQuery) -> tuple[bool, bool]:
    """Whether capped sources were level with their goals (see ``tail``) before and after the query's last batch."""
    def level(offset: object) -> bool:
        known = isinstance(offset, dict) and all(isinstance(e, dict) and "goal" in e for e in offset.values())
        return not known or tail.is_level(offset)

    last = query.lastProgress
    sources = json.loads(last.json)["sources"] if last else []
    return all(level(s["startOffset"]) for s in sources), all(level(s["endOffset"]) for s in sources)


def printed(lines: DataFrame, column: str = "report", prefix: str = device.PRINT_PREFIX) -> DataFrame:
    """The lines as printed."""
    return lines.select(F.concat(F.lit(prefix), F.col(column)).alias("line"))


def print_lines(lines: DataFrame, checkpoint: str, rows: int | None = None, interval: str = COMMIT_INTERVAL,
                once: bool = False, **options) -> StreamingQuery:
    """Print every line on the driver's console, a partition at a time; with ``rows`` only each batch's first ones."""
    def batch(found: DataFrame, _: int) -> None:
        for row in (found if rows is None else found.limit(rows)).toLocalIterator():
            print(row["line"])

    return _started(printed(lines, **options).writeStream.foreachBatch(batch), checkpoint, interval, once)


def write_lines(lines: DataFrame, path: str, checkpoint: str, interval: str = COMMIT_INTERVAL,
                once: bool = False) -> StreamingQuery:
    """Keep the rows in parquet files, each batch visible as a whole."""
    return _started(lines.writeStream.format("parquet").option("path", path), checkpoint, interval, once)


def send(records: DataFrame, settings: Mapping[str, str], topic: str, checkpoint: str,
         interval: str = COMMIT_INTERVAL, once: bool = False, limit: int | None = None,
         oversized: str | None = None) -> StreamingQuery:
    """Send key and value columns to a topic (at least once).

    With a ``limit``, records whose value is larger go to parquet files below
    ``oversized`` instead; every record ends in one of the two.
    """
    options = kafka.sink_options(settings, topic)
    if limit is None:
        return _started(records.writeStream.format("kafka").options(**options), checkpoint, interval, once)
    if oversized is None:
        raise ValueError("a limit needs a folder for oversized records")

    def batch(rows: DataFrame, batch_id: int) -> None:
        split_send(rows, limit, f"{oversized}/batch={batch_id}",
                   lambda fitting: fitting.write.format("kafka").options(**options).save())

    return _started(records.writeStream.foreachBatch(batch), checkpoint, interval, once)


def split_send(rows: DataFrame, limit: int, oversized: str, sink: Callable[[DataFrame], None]) -> None:
    """Oversized rows into a folder, replacing what an earlier attempt left there; the others to the sink."""
    fitting, large = kafka.within_size(rows, limit)
    large.write.mode("overwrite").parquet(oversized)
    sink(fitting)


#: Where a message stands among all of a topic: by time, then by its place, so that no two tie.
ARRIVAL = "arrival"
ARRIVAL_TYPE = T.StructType([T.StructField("timestamp", T.TimestampType()), T.StructField("partition", T.IntegerType()),
                             T.StructField("offset", T.LongType())])


def lake_table(spark: SparkSession, path: str, arrival: str = "seq",
               arrival_type: T.DataType = T.LongType()) -> LakeTable:
    """The keyed log table: one row per application and second, partitioned by day."""
    types = {"unix_time_stamp": "long"}
    columns = ", ".join(f"{c} {types.get(c, 'string')}" for c in logs.LAKE_COLUMNS)
    schema = spark.createDataFrame([], columns).schema
    return LakeTable(spark, path, schema, ["app_name", "unix_time_stamp", "load_dt"], "unix_time_stamp", "load_dt",
                     arrival, arrival_type=arrival_type)


def message_table(spark: SparkSession, path: str) -> LakeTable:
    """The same, its rows ordered by the place of their messages in the queue."""
    return lake_table(spark, path, ARRIVAL, ARRIVAL_TYPE)


def upsert_messages(records: DataFrame, table: LakeTable, rejects: str, checkpoint: str, **options) -> StreamingQuery:
    """Queue records whose values are JSON logs into the keyed table of :func:`message_table`, in one job.

    A message is parsed once and ends in exactly one place: the table, where a later message of its key takes
    its place, or ``rejects``, with its text if it is no JSON, its columns if its key is incomplete, and the reason.
    ``options`` are those of :func:`upsert_logs`.
    """
    arrival = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ARRIVAL_TYPE]).alias(ARRIVAL)
    raw = kafka.json_table(records, logs.LOG_SCHEMA, arrival, unreadable=logs.UNREADABLE)
    return upsert_logs(raw, table, rejects, checkpoint, **options)


def read_message_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The messages that :func:`upsert_messages` set aside so far."""
    return _read_rejects(spark, path, f"{ARRIVAL} {ARRIVAL_TYPE.simpleString()}, {logs.UNREADABLE} string")


def upsert_logs(raw: DataFrame, table: LakeTable, rejects: str, checkpoint: str, precision: str = "seconds",
                compact_every: int | None = None, interval: str = COMMIT_INTERVAL,
                once: bool = False) -> StreamingQuery:
    """Raw log rows (seven columns and the table's order of arrival) into the keyed table, others into ``rejects``."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        # The query's id is kept in its checkpoint: with a new checkpoint, batches count as another writer's.
        writer = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        kept = [table.arrival, *[c for c in [logs.UNREADABLE] if c in rows.columns]]
        normal = logs.normalize_logs(rows, *kept, precision=precision)
        counted, seen = counters.observed(normal, f"upsert-{batch_id}", logs.is_usable(normal))
        written = table.upsert(logs.log_rows(counted), batch_id, writer)
        # The source is read a second time only if some row was set aside, or on a repeat that cannot tell.
        if not written or seen.get["ok_rows"] < seen.get["rows"]:
            logs.log_rejects(normal).write.mode("overwrite").parquet(f"{rejects}/writer={writer}/batch={batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()

    return _started(raw.writeStream.foreachBatch(batch), checkpoint, interval, once)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The log rows set aside so far, with the reason."""
    return _read_rejects(spark, path, "seq long")


def _read_rejects(spark: SparkSession, path: str, kept: str) -> DataFrame:
    fields = {"unix_time_stamp": "long"}
    schema = ", ".join(f"{c} {fields.get(c, 'string')}" for c in logs.LAKE_COLUMNS) + f", {kept}, reason string"
    found = [f"{path}/{w}/{b}" for w in folders.child_folders(spark, path, "writer=")
             for b in folders.child_folders(spark, f"{path}/{w}", "batch=")]
    paths = [p for p in found if folders.is_done(spark, p)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def with_day(lines: DataFrame, arrival: Column | None = None) -> DataFrame:
    """The day a line arrived, in the session's time zone."""
    at = F.current_timestamp() if arrival is None else arrival
    return lines.withColumn(DAY_COLUMN, F.date_format(at, "yyyy-MM-dd"))


def archive_batch(lines: DataFrame, path: str, value: str = "value", batch: str | None = None) -> None:
    """Gzip text files per day: a day with many lines is split at the roll size, a small day stays in one file.

    The files lie in ``load_date=<day>/batch=<name>``; a batch written again
    under its name replaces itself, an unnamed one adds to its days.
    """
    name = F.lit(batch or uuid.uuid4().hex).alias("batch")
    rows = lines.select(value, DAY_COLUMN, name).hint("rebalance", F.col(DAY_COLUMN))
    with session.conf(lines.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": ROLL_BYTES}):
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY_COLUMN, "batch")
         .option("compression", "gzip").text(path))


def archive_stream(lines: DataFrame, path: str, checkpoint: str, value: str = "value",
                   interval: str = ROLL_INTERVAL, once: bool = False) -> StreamingQuery:
    """The same from a stream: files roll with each trigger and at the roll size; a repeated batch replaces itself.

    Plain folders without a log of files, so that expired days can be removed below running readers.
    """
    def batch(rows: DataFrame, batch_id: int) -> None:
        writer = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        archive_batch(rows, path, value, f"{writer}-{batch_id}")

    return _started(lines.writeStream.foreachBatch(batch), checkpoint, interval, once)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived lines with their day."""
    return spark.read.schema(f"value string, {DAY_COLUMN} string, batch string").text(path).drop("batch")


def roll_stream(lines: DataFrame, path: str, checkpoint: str, value: str = "value", prefix: str = rolling.PREFIX,
                roll_bytes: int = ROLL_BYTES, tasks: int | None = None, interval: str = ROLL_INTERVAL,
                once: bool = False) -> StreamingQuery:
    """Lines with their day into gzip text files ``load_date=<day>/<prefix>….txt.gz`` of at most ``roll_bytes`` of text.

    Each line lands once, also over failures; files roll by size and with each trigger. Nothing is shuffled: a task
    writes its own files, so ``tasks`` (by default the source's) bounds the small ones that a quiet day gets.
    """
    rolling.register(lines.sparkSession)
    rows = lines.select(F.col(value).alias("value"), F.col(DAY_COLUMN).cast("string").alias(DAY_COLUMN))
    writer = (rows if tasks is None else rows.coalesce(tasks)).writeStream.format(rolling.FORMAT).options(
        path=folders.qualified(lines.sparkSession, path), log=folders.qualified(lines.sparkSession, f"{checkpoint}/rolled"),
        dayColumn=DAY_COLUMN, prefix=prefix, rollBytes=roll_bytes)
    return _started(writer, checkpoint, interval, once)


def read_rolled(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a rolled archive with their day."""
    return spark.read.schema(f"value string, {DAY_COLUMN} string").text(path)


def expire_days(spark: SparkSession, path: str, as_of: str, keep_days: int = 7) -> list[str]:
    """Remove day folders past retention below a root this package writes."""
    names = folders.child_folders(spark, path, f"{DAY_COLUMN}=")
    days = spark.createDataFrame([(n.split("=", 1)[1],) for n in names], f"{DAY_COLUMN} string")
    plan = lake.retention_plan(days, DAY_COLUMN, as_of, keep_days).where("expired")
    gone = sorted(r[DAY_COLUMN] for r in plan.toLocalIterator())
    for day in gone:
        folders.remove(spark, f"{path}/{DAY_COLUMN}={day}")
    return gone


def drain(query: StreamingQuery) -> None:
    """Let a running query take all its sources hold, in as many batches as their caps need, then stop it.

    A capped source gives an available-now run only one capped batch, so use
    this with a processing-time query when everything must be through.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()
