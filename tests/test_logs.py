from datetime import datetime

import pytest
from pyspark.sql import functions as F

from penstock.functions import logs
from penstock.operators import keyed, lake
from penstock.sources import kafka, line_files

SCHEMA = "app_name string, time_stamp string, level string, logger string, message string, thread string, " \
         "exception string, seq long"


def log_row(time_stamp, app="a", level=" INFO ", seq=0):
    return (app, time_stamp, level, "l", "m", "t", None, seq)


@pytest.mark.parametrize("time_stamp, seconds, millis", [
    ("2024-01-01 00:00:00.987", 1704067200000, 1704067200987),
    ("2024-01-01 00:00:00.000", 1704067200000, 1704067200000),
    ("2024-01-01 00:00:00", None, None),
    ("bad", None, None),
    ("2024-02-30 00:00:00.000", None, None),
    (None, None, None),
])
def test_epoch_key(spark, time_stamp, seconds, millis):
    df = spark.createDataFrame([(time_stamp,)], "t string")
    row = df.select(logs.epoch_key("t").alias("s"), logs.epoch_key("t", "millis").alias("m")).first()
    assert (row["s"], row["m"]) == (seconds, millis)


def test_epoch_key_reads_what_the_format_reads(spark):
    whole = "2024-02-29 23:59:59.987"
    texts = {whole[:i] + c + whole[i + 1:] for i in range(len(whole)) for c in "0369 -:.T+xZ\n"}
    texts |= {whole[:i] + whole[i + 1:] for i in range(len(whole))}
    texts |= {whole[:i] + c + whole[i:] for i in range(len(whole) + 1) for c in "0 +\n\t"}
    texts |= {"0000-01-01 00:00:00.000", "2023-02-29 00:00:00.000", "2024-01-01 24:00:00.000", "1969-12-31 23:59:59.001"}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "t string")
    parsed = F.try_to_timestamp("t", F.lit(logs.TIME_FORMAT))
    rows = df.select("t", logs.epoch_key("t").alias("s"), (F.unix_seconds(parsed) * 1000).alias("ps"),
                     logs.epoch_key("t", "millis").alias("m"), F.unix_millis(parsed).alias("pm")).collect()
    assert [r for r in rows if (r["s"], r["m"]) != (r["ps"], r["pm"])] == []
    assert sum(r["s"] is not None for r in rows) > 20


def test_epoch_key_refuses_other_precisions():
    with pytest.raises(ValueError):
        logs.epoch_key("t", "days")


def test_rows_and_rejects_are_the_whole(spark):
    raw = spark.createDataFrame(
        [log_row("2024-01-01 00:00:00.987"), log_row("bad"), log_row(None), log_row("2024-01-01 00:00:00.000", None)],
        SCHEMA)
    normal = logs.normalize_logs(raw, "seq")
    assert logs.log_rows(normal).count() == 1
    assert sorted(r["reason"] for r in logs.log_rejects(normal).collect()) == [
        "missing app_name", "unreadable time_stamp", "unreadable time_stamp"]


def test_level_trims_spaces_only(spark):
    raw = spark.createDataFrame([log_row("x", level=" INFO "), log_row("x", level="INFO\t"), log_row("x", level=None)],
                                SCHEMA)
    assert [r["level"] for r in logs.normalize_logs(raw).collect()] == ["INFO", "INFO\t", None]


def test_lines_within_a_second_collapse_to_the_last(spark):
    raw = spark.createDataFrame(
        [log_row("2024-01-01 00:00:00.100", seq=1), log_row("2024-01-01 00:00:00.900", seq=2),
         log_row("2024-01-01 00:00:00.500", seq=3)], SCHEMA)
    key = ["app_name", "unix_time_stamp"]
    kept = keyed.latest_per_key(logs.normalize_logs(raw, "seq"), key, ["seq"]).collect()
    assert [r["time_stamp"] for r in kept] == ["2024-01-01 00:00:00.500"]
    assert keyed.latest_per_key(logs.normalize_logs(raw, "seq", precision="millis"), key, ["seq"]).count() == 3


def test_json_table_sets_unreadable_messages_aside(spark):
    records = spark.createDataFrame([(bytearray(b'{"app_name":"a","extra":1}'),), (bytearray(b"{oops"),), (None,)],
                                    "value binary")
    rows = kafka.json_table(records, logs.LOG_SCHEMA).collect()
    assert [r["app_name"] for r in rows] == ["a", None, None]
    kept = kafka.json_table(records, logs.LOG_SCHEMA, unreadable="unreadable")
    rejects = logs.log_rejects(logs.normalize_logs(kept, "unreadable")).collect()
    assert sorted((r["reason"], r["unreadable"] or "") for r in rejects) == [
        ("invalid json", "{oops"), ("missing app_name", ""), ("unreadable time_stamp", "")]


@pytest.mark.parametrize("level, limit, shown", [
    ("debug", "INFO", False), ("INFO", "INFO", True), ("warn", "INFO", True), ("ERROR", "WARN", True),
    ("WARN", "ERROR", False), ("DEBUG", "DEBUG", True), ("TRACE", "ERROR", True), ("DEBUG", None, False),
])
def test_severity(spark, level, limit, shown):
    df = spark.createDataFrame([(level,)], "level string")
    assert df.select(logs.severity_allows("level", limit)).first()[0] is shown


def test_composed_line(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5, 6789), "warn", "hello")], "ts timestamp, l string, m string")
    assert df.select(logs.compose_line(logs.format_time("ts"), "l", "m")).first()[0] == \
        "2024-01-02 03:04:05.006 [WARN] hello"


@pytest.mark.parametrize("path, name", [
    ("/var/log/app/a.log", "a.log"), ("a.log", None), ("/x/a.log.gz", None), ("/x/.log", None), ("/d.log/e.log", "e.log"),
    (None, None),
])
def test_log_file_name(spark, path, name):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(logs.log_file_name("p")).first()[0] == name


@pytest.mark.parametrize("path, unsafe, below", [
    ("/a/b/c", False, True), ("/a/b", False, True), ("/a/bc", False, False), ("/a/b/../c", True, True),
    ("/a/b//c", True, True), ("/a/./b", True, False), ("/a/b/..", True, True), ("/a/b/.hidden", False, True),
])
def test_paths(spark, path, unsafe, below):
    df = spark.createDataFrame([(path,)], "p string")
    assert tuple(df.select(logs.is_unsafe_path("p"), logs.is_below("p", "/a/b/")).first()) == (unsafe, below)


def test_message_size_counts_bytes(spark):
    df = spark.createDataFrame([("é" * 5,), ("e" * 5,), (None,)], "v string")
    kept, refused = kafka.within_size(df, 9, "v")
    assert (kept.count(), refused.count()) == (2, 1)


def test_first_match(spark):
    rows = [("a", 1, 1, "id7"), ("a", 0, 2, "id8"), ("a", 0, 1, "none"), ("b", 0, 1, "none")]
    df = spark.createDataFrame(rows, "run string, file_rank int, line_no int, line string")
    found = keyed.first_match(df, ["run"], F.regexp_extract("line", "id[0-9]", 0), ["file_rank", "line_no"])
    assert {r["run"]: r["match"] for r in found.collect()} == {"a": "id8", "b": None}


def test_retention_keeps_the_last_full_days(spark):
    df = spark.createDataFrame([("2024-01-23",), ("2024-01-24",), ("2024-01-31",)], "load_date string")
    plan = lake.retention_plan(df, "load_date", "2024-01-31").collect()
    assert {r["load_date"]: r["expired"] for r in plan} == {
        "2024-01-23": True, "2024-01-24": False, "2024-01-31": False}


def test_closed_files_by_name_and_path(spark, folder):
    import pathlib
    for name in ("a.log", "sub/b.log", "c.txt"):
        file = pathlib.Path(folder, name)
        file.parent.mkdir(exist_ok=True)
        file.write_text(f"{name}\n")
    lines = line_files.read_lines(spark, folder)
    assert sorted(r["value"] for r in lines.collect()) == ["a.log", "sub/b.log"]
    only = line_files.read_lines(spark, folder, pattern=r".*/sub/[^/]+\.log")
    assert [r["value"] for r in only.collect()] == ["sub/b.log"]


def test_a_folder_that_is_no_day_never_expires(spark):
    df = spark.createDataFrame([("__HIVE_DEFAULT_PARTITION__",), ("2020-01-01",)], "load_date string")
    plan = lake.retention_plan(df, "load_date", "2024-01-31").collect()
    assert {r["load_date"]: r["expired"] for r in plan} == {"__HIVE_DEFAULT_PARTITION__": False, "2020-01-01": True}
