"""The streaming jobs run to the end of the given tables; results equal the batch queries'."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.functions import device, logs
from penstock.operators import counters
from penstock.plans import device_queries, fixtures, log_queries
from penstock.session import conf, fresh_folder
from penstock.sources import kafka, tail
from penstock.streaming import jobs

PLACE = device_queries.PLACE
BATCH_BYTES, SPLIT_BYTES = 64 << 20, 4 << 20


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream; the bracket makes the path a pattern, so one file or a folder both do."""
    schema = fixtures.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def stream_device_report(spark, sf_dir):
    folder = fresh_folder(spark, "stream-device")
    messages = fixtures.device_messages(_table_stream(spark, sf_dir, "events"))
    lines = device.report_full(messages, *PLACE)
    jobs.write_lines(lines, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(lines.schema).parquet(f"{folder}/out")


def _upserted(spark, sf_dir):
    folder = fresh_folder(spark, "stream-lake")
    table = jobs.lake_table(spark, f"{folder}/table")
    raw = fixtures.app_logs(_table_stream(spark, sf_dir, "events"))
    jobs.upsert_logs(raw, table, f"{folder}/rejects", f"{folder}/checkpoint", once=True).awaitTermination()
    return table, folder


def stream_log_lake(spark, sf_dir):
    """The keyed table's merged view after streaming all logs into it."""
    table, _ = _upserted(spark, sf_dir)
    return table.snapshot().select(*logs.LAKE_COLUMNS)


def stream_log_lake_compacted(spark, sf_dir):
    """The same after compaction."""
    table, _ = _upserted(spark, sf_dir)
    table.compact()
    return table.snapshot().select(*logs.LAKE_COLUMNS)


def stream_log_rejects(spark, sf_dir):
    _, folder = _upserted(spark, sf_dir)
    return jobs.read_rejects(spark, f"{folder}/rejects").select("seq", "app_name", "time_stamp", "reason")


def _messages_upserted(spark, sf_dir):
    folder = fresh_folder(spark, "stream-messages")
    table = jobs.message_table(spark, f"{folder}/table")
    records = fixtures.faulty_log_messages(_table_stream(spark, sf_dir, "events"))
    jobs.upsert_messages(records, table, f"{folder}/rejects", f"{folder}/checkpoint", once=True).awaitTermination()
    return table, folder


def stream_log_messages(spark, sf_dir):
    """Queue messages, some unreadable, into the keyed table in one job: its merged view."""
    table, _ = _messages_upserted(spark, sf_dir)
    return table.snapshot().select(*logs.LAKE_COLUMNS)


def stream_message_rejects(spark, sf_dir):
    """The messages that the same job set aside, with their place and the reason."""
    _, folder = _messages_upserted(spark, sf_dir)
    return jobs.read_message_rejects(spark, f"{folder}/rejects").select(
        "arrival.partition", "arrival.offset", "app_name", "time_stamp",
        F.col(logs.UNREADABLE).isNotNull().alias("has_text"), "reason")


def stream_first_records(spark, sf_dir):
    """Records that were sent more than once, some in later batches, read once each."""
    folder = fresh_folder(spark, "stream-repeats")
    sent = fixtures.repeated_records(fixtures.table(spark, sf_dir, "events"))
    # A file is a batch: their size does not depend on how many tasks read the table, and several tasks read one file.
    with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": BATCH_BYTES}):
        sent.hint("rebalance", "sending").write.partitionBy("sending").option("parquet.block.size", SPLIT_BYTES).parquet(
            f"{folder}/in")
    records = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    with conf(spark, kafka.state_settings(spark)):
        once = kafka.first_of_each(kafka.with_sent_place(records.drop("sending")), "sent_topic", "sent_partition",
                                   "sent_offset")
        jobs.write_lines(once, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{folder}/out").select(
        F.col("sent_partition").alias("partition"), F.col("sent_offset").alias("offset"), "value")


def _archive_lines(spark, sf_dir):
    rows = fixtures.app_logs(_table_stream(spark, sf_dir, "events"))
    return jobs.with_day(rows.select(logs.compose_line("time_stamp", "level", "message").alias("value"), "arrival_ts"),
                         F.col("arrival_ts"))


def _day_sizes(lines):
    return lines.groupBy("load_date").agg(F.count("*").alias("lines"), F.sum(F.octet_length("value") + 1).alias("bytes"))


def stream_daily_archive(spark, sf_dir):
    folder = fresh_folder(spark, "stream-archive")
    lines = _archive_lines(spark, sf_dir)
    jobs.archive_stream(lines, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return _day_sizes(jobs.read_archive(spark, f"{folder}/out"))


def stream_rolling_archive(spark, sf_dir):
    """The same through the sink whose tasks roll their own files."""
    folder = fresh_folder(spark, "stream-rolling")
    lines = _archive_lines(spark, sf_dir)
    jobs.roll_stream(lines, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return _day_sizes(jobs.read_rolled(spark, f"{folder}/out"))


def stream_batch_counts(spark, sf_dir):
    """What the batches of a running stream counted, read from the table of counts afterwards."""
    folder = fresh_folder(spark, "stream-counts")
    fixtures.table(spark, sf_dir, "events").select("event_id").repartition(4).write.parquet(f"{folder}/in")
    events = spark.readStream.schema("event_id long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    counted = counters.observed_stream(events, "events", counters.is_progress_mark(F.col("event_id") + 1))
    with counters.kept_counts(spark, f"{folder}/counts") as keeper:
        query = jobs.write_lines(counted, f"{folder}/out", f"{folder}/checkpoint", once=True)
        if not keeper.wait(query) or keeper.failed:
            raise RuntimeError(f"counts are incomplete: {keeper.failed}")
    return counters.read_counts(spark, f"{folder}/counts").groupBy("name").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("counts.rows").alias("rows"),
        F.sum("counts.ok_rows").alias("marks"))


def stream_tail_files(spark, sf_dir):
    """Log files followed by the tail source until nothing is left, in capped batches."""
    folder = fresh_folder(spark, "stream-tail")
    path = log_queries._written_lines(spark, sf_dir)
    largest = max(tail.list_sizes(path, r".*/part-.*\.txt").values(), default=1)
    lines = tail.read_stream(spark, path, pattern=r".*/source=[^/]+/part-.*\.txt", maxBytesPerFile=largest // 2 + 1)
    jobs.drain(jobs.write_lines(lines, f"{folder}/out", f"{folder}/checkpoint", interval="0 seconds"))
    return log_queries._with_source(spark.read.schema(tail.SCHEMA).parquet(f"{folder}/out"))


QUERIES = {f.__name__: f for f in [
    stream_device_report, stream_log_lake, stream_log_lake_compacted, stream_log_rejects, stream_log_messages,
    stream_message_rejects, stream_first_records, stream_daily_archive,
    stream_rolling_archive, stream_batch_counts, stream_tail_files,
]}

ORACLE = {
    "stream_device_report": device_queries.ORACLE["device_report_full"],
    "stream_log_lake": log_queries.LAKE_UPSERT_SQL,
    "stream_log_lake_compacted": log_queries.LAKE_UPSERT_SQL,
    "stream_log_rejects": log_queries.ORACLE["log_rejects"],
    "stream_log_messages": log_queries.MESSAGE_LAKE_SQL,
    "stream_message_rejects": log_queries.MESSAGE_REJECTS_SQL,
    "stream_first_records": """
SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id AS "offset", props AS value FROM events""",
    "stream_daily_archive": log_queries.ARCHIVE_SQL,
    "stream_rolling_archive": log_queries.ARCHIVE_SQL,
    "stream_batch_counts": """
SELECT 'events' AS name, count(*) AS input_rows, count(*) AS rows, count(*) FILTER ((event_id + 1) % 10 = 0) AS marks
FROM events HAVING count(*) > 0""",
    "stream_tail_files": log_queries.SOURCE_LINES_SQL,
}
