"""Streams give the batch result; restarts and repeats add nothing."""

import pathlib
from collections import Counter

from pyspark.sql import functions as F

from penstock.functions import device, logs
from penstock.operators import counters
from penstock.plans import fixtures
from penstock.sources import generator, tail
from penstock.streaming import jobs


def split_input(spark, sf_dir, folder, parts):
    """The events as several files, so a stream takes several batches."""
    events = fixtures.table(spark, sf_dir, "events")
    events.repartition(parts, "event_id").write.parquet(folder)
    return events


def source(spark, events, folder):
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_device_stream_equals_batch_over_restarts(spark, sf_dir, folder):
    events = split_input(spark, sf_dir, f"{folder}/in", 3)
    want = rows(device.report_full(fixtures.device_messages(events), "offset"))
    for _ in range(2):
        lines = device.report_full(fixtures.device_messages(source(spark, events, f"{folder}/in")), "offset")
        query = jobs.write_lines(lines, f"{folder}/out", f"{folder}/checkpoint", once=True)
        query.awaitTermination()
        assert rows(spark.read.schema(lines.schema).parquet(f"{folder}/out")) == want


def test_upsert_stream_equals_batch_with_compactions(spark, sf_dir, folder):
    events = split_input(spark, sf_dir, f"{folder}/in", 4)
    table = jobs.lake_table(spark, f"{folder}/table")
    for _ in range(2):
        raw = fixtures.app_logs(source(spark, events, f"{folder}/in"))
        jobs.upsert_logs(raw, table, f"{folder}/rejects", f"{folder}/checkpoint", compact_every=3,
                         once=True).awaitTermination()
    assert table.versions() == [2]
    assert table.batches() == [0, 1, 2, 3]
    # Files arrive in any order, so only the keys are fixed, not which line of a second came last.
    normal = logs.normalize_logs(fixtures.app_logs(events), "seq")
    keys = logs.log_rows(normal).select("app_name", "unix_time_stamp", "load_dt").distinct()
    assert rows(table.snapshot().select("app_name", "unix_time_stamp", "load_dt")) == rows(keys)
    assert jobs.read_rejects(spark, f"{folder}/rejects").count() == logs.log_rejects(normal).count()


def test_new_checkpoint_loses_nothing(spark, sf_dir, folder):
    events = fixtures.table(spark, sf_dir, "events")
    table = jobs.lake_table(spark, f"{folder}/table")
    for half in (0, 1):
        events.where(f"event_id % 2 = {half}").write.parquet(f"{folder}/in{half}")
        raw = fixtures.app_logs(source(spark, events, f"{folder}/in{half}"))
        jobs.upsert_logs(raw, table, f"{folder}/rejects", f"{folder}/checkpoint{half}", compact_every=1,
                         once=True).awaitTermination()
    normal = logs.normalize_logs(fixtures.app_logs(events), "seq")
    assert table.snapshot().count() == logs.log_rows(normal).select("app_name", "unix_time_stamp").distinct().count()
    assert jobs.read_rejects(spark, f"{folder}/rejects").count() == logs.log_rejects(normal).count()


def test_upsert_stream_without_rejects(spark, sf_dir, folder):
    events = fixtures.table(spark, sf_dir, "events").where("event_id % 37 != 0")
    events.write.parquet(f"{folder}/in")
    table = jobs.lake_table(spark, f"{folder}/table")
    raw = fixtures.app_logs(source(spark, events, f"{folder}/in"))
    jobs.upsert_logs(raw, table, f"{folder}/rejects", f"{folder}/checkpoint", once=True).awaitTermination()
    assert jobs.read_rejects(spark, f"{folder}/rejects").count() == 0
    assert not pathlib.Path(folder, "rejects").exists()


def test_archive_stream_writes_gzip_per_day_and_expires(spark, sf_dir, folder):
    events = split_input(spark, sf_dir, f"{folder}/in", 2)
    raw = source(spark, events, f"{folder}/in")
    lines = jobs.with_day(raw.select(F.col("props").alias("value"), F.col("ts").cast("timestamp").alias("ts")),
                          F.col("ts"))
    jobs.archive_stream(lines, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    files = list(pathlib.Path(folder, "out").glob("load_date=*/batch=*/*.txt.gz"))
    assert files
    want = events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("load_date"), "props").count()
    assert rows(jobs.read_archive(spark, f"{folder}/out").groupBy("load_date", "value").count()) == rows(want)
    days = sorted(r["load_date"] for r in want.select("load_date").distinct().collect())
    assert jobs.expire_days(spark, f"{folder}/out", days[-1], keep_days=0) == days[:-1]
    left = jobs.read_archive(spark, f"{folder}/out").groupBy("load_date", "value").count()
    assert rows(left) == rows(want.where(F.col("load_date") == days[-1]))


def test_expired_days_are_removed(spark, folder):
    lines = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-23"), ("c", "2024-01-24")],
                                  "value string, load_date string")
    jobs.archive_batch(lines, f"{folder}/out")
    assert jobs.expire_days(spark, f"{folder}/out", "2024-01-31") == ["2024-01-01", "2024-01-23"]
    assert [tuple(r) for r in jobs.read_archive(spark, f"{folder}/out").collect()] == [("c", "2024-01-24")]


def test_archive_batch_replaces_itself(spark, folder):
    for name, text in (("x", "a"), ("x", "b"), ("y", "c")):
        lines = spark.createDataFrame([(text, "2024-01-01")], "value string, load_date string")
        jobs.archive_batch(lines, folder, batch=name)
    assert sorted(r["value"] for r in jobs.read_archive(spark, folder).collect()) == ["b", "c"]


def test_every_line_is_printed(spark, folder, capfd):
    spark.range(60).selectExpr("concat('line ', id) as report").write.parquet(f"{folder}/in")
    lines = spark.readStream.schema("report string").parquet(f"{folder}/in")
    jobs.print_lines(lines, f"{folder}/checkpoint", prefix="", once=True)
    assert sorted(capfd.readouterr().out.split("\n")) == sorted(["", *(f"line {i}" for i in range(60))])


def test_a_capped_source_is_taken_to_its_end(spark, folder):
    pathlib.Path(folder, "in").mkdir()
    pathlib.Path(folder, "in", "a.log").write_text("".join(f"line {i}\n" for i in range(103)))
    lines = tail.read_stream(spark, f"{folder}/in", maxBytesPerFile=200)
    jobs.write_lines(lines, f"{folder}/out", f"{folder}/checkpoint", once=True)
    assert spark.read.schema(tail.SCHEMA).parquet(f"{folder}/out").count() == 103


def test_archive_adds_to_a_day(spark, folder):
    for text in ("a", "b"):
        jobs.archive_batch(spark.createDataFrame([(text, "2024-01-01")], "value string, load_date string"), folder)
    assert sorted(r["value"] for r in jobs.read_archive(spark, folder).collect()) == ["a", "b"]


def test_printed_lines_carry_the_prefix(spark, sf_dir, folder):
    events = split_input(spark, sf_dir, f"{folder}/in", 1)
    batch = jobs.printed(device.report_full(fixtures.device_messages(events)))
    assert batch.where("line like '处理结果: 事件类型: device_status | 设备ID: device-%'").count() > 0
    assert batch.where("line not like '处理结果: %'").count() == 0
    lines = device.report_full(fixtures.device_messages(source(spark, events, f"{folder}/in")))
    query = jobs.print_lines(lines, f"{folder}/checkpoint", rows=3, once=True)
    query.awaitTermination()
    assert query.recentProgress[0]["numInputRows"] == events.count()


def test_progress_reports_counts(spark, sf_dir, folder):
    events = split_input(spark, sf_dir, f"{folder}/in", 2)
    parsed = device.parse_events(fixtures.device_messages(source(spark, events, f"{folder}/in")))
    counted = counters.observed_stream(parsed, "messages", F.col("ok"))
    query = jobs.write_lines(counted.select("offset"), f"{folder}/out", f"{folder}/checkpoint", once=True)
    query.awaitTermination()
    seen = [p["observedMetrics"]["messages"] for p in query.recentProgress if p["observedMetrics"]]
    good = device.parse_events(fixtures.device_messages(events)).where("ok").count()
    assert sum(m["rows"] for m in seen) == events.count()
    assert sum(m["ok_rows"] for m in seen) == good


def test_generator_stream_stops_after_its_records(spark, folder):
    made = generator.as_message(generator.generate_stream(spark, records=25, rows_per_batch=10))
    query = jobs.write_lines(made, f"{folder}/out", f"{folder}/checkpoint", interval="0 seconds")
    try:
        while query.lastProgress is None or query.lastProgress["batchId"] < 4:
            query.awaitTermination(1)
            assert query.exception() is None
    finally:
        query.stop()
    found = spark.read.schema("n long, value string").parquet(f"{folder}/out").orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(25))
    assert '"id":"device-10024"' in found[-1]["value"]
