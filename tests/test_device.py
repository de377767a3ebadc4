"""The malformed-message table, row by row."""

import pytest
from pyspark.sql import functions as F

from penstock.functions import device
from penstock.operators import counters
from penstock.sources import generator

N = "null"
# value, the five printed fields or None when the message goes to quarantine, reason
HAND_ROWS = [
    ('{"event":"device_status","timestamp":1672531200000,"payload":{"id":"device-10001","status":"online",'
     '"temperature":25,"voltage":4.20}}', ["device_status", "device-10001", "online", "25", "4.2"], None),
    ('{"event":"data_update","timestamp":1,"payload":{"id":1001,"name":"x","status":"active"}}',
     ["data_update", "1001", "active", N, N], None),
    ('{"event":"x","payload":{}}', ["x", N, N, N, N], None),
    ('{"event":null,"payload":{"id":null}}', [N, N, N, N, N], None),
    ('{"event":"a","event":"b","payload":{}}', ["b", N, N, N, N], None),
    ('{"event":"x","payload":{"id":1}} trailing', ["x", "1", N, N, N], None),
    ('{"event":"x","payload":{"voltage":1e2}}', ["x", N, N, N, "100.0"], None),
    ('{"event":"x","payload":{"status":true}}', ["x", N, "true", N, N], None),
    ('{"event":"x","payload":{"id":{"k":1}}}', ["x", '{"k":1}', N, N, N], None),
    ('{"event":"x","timestamp":"abc","payload":{"id":1}}', ["x", "1", N, N, N], None),
    ('{"event":"x"}', None, device.PAYLOAD_MISSING),
    ('{"event":"x","payload":null}', None, device.PAYLOAD_MISSING),
    ('{"event":"x","payload":[1]}', None, device.PAYLOAD_NOT_OBJECT),
    ('{"event":"x","payload":"s"}', None, device.PAYLOAD_NOT_OBJECT),
    ('{"event":"x","payload":{"id":1}', None, device.INVALID_JSON),
    ("{'event':'x','payload':{}}", None, device.INVALID_JSON),
    ("[1]", None, device.INVALID_JSON),
    ("", None, device.INVALID_JSON),
    ("   ", None, device.INVALID_JSON),
    (None, None, device.NULL_MESSAGE),
]


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(i, 0, v) for i, (v, _, _) in enumerate(HAND_ROWS)]
    return spark.createDataFrame(rows, "offset long, partition int, value string")


def by_offset(df):
    return {r["offset"]: r for r in df.collect()}


def test_full_report(messages):
    found = by_offset(device.report_full(messages, "offset"))
    for i, (value, fields, _) in enumerate(HAND_ROWS):
        if value is None:
            assert i not in found
        elif fields:
            assert found[i]["report"] == device.REPORT_FULL % tuple(fields)
        else:
            assert found[i]["report"] == "解析失败: " + value[:100] + "..."


def test_short_report(messages):
    found = by_offset(device.report_short(messages, "offset"))
    for i, (value, fields, _) in enumerate(HAND_ROWS):
        if value is not None:
            want = device.REPORT_SHORT % tuple(fields[:3]) if fields else "JSON解析失败: " + value
            assert found[i]["report"] == want


def test_client_report(messages):
    found = by_offset(device.report_client(messages, "offset", "partition"))
    assert set(found) == {i for i, r in enumerate(HAND_ROWS) if r[1]}
    assert found[0]["report"] == (
        "\n[Consumer] 收到JSON消息 → 分区:0 偏移量:0\n  事件:device_status\n  设备ID:device-10001\n  状态:online\n")


def test_quarantine(messages):
    found = by_offset(device.quarantine(messages, "offset"))
    assert {i: r["reason"] for i, r in found.items()} == {
        i: reason for i, (_, fields, reason) in enumerate(HAND_ROWS) if fields is None}


def test_long_bad_message_is_cut_in_the_excerpt_only(spark):
    text = "x" * 250
    row = device.quarantine(spark.createDataFrame([(text,)], "value string")).first()
    assert row["excerpt_text"] == "解析失败: " + "x" * 100 + "..."
    assert row["whole_text"] == "JSON解析失败: " + text
    assert row["value"] == text


def test_generator(spark):
    made = generator.generate(spark, 25, seed=3)
    rows = made.orderBy("n").collect()
    assert [r["id"] for r in rows] == [f"device-{10000 + i}" for i in range(25)]
    assert all(r["status"] in device.DEVICE_STATES for r in rows)
    assert all(20 <= r["temperature"] <= 34 and 3.5 <= r["voltage"] < 5.0 for r in rows)
    again = generator.generate(spark, 25, seed=3).orderBy("n").collect()
    assert [r["voltage"] for r in rows] == [r["voltage"] for r in again]
    lines = device.report_full(generator.as_message(made)).collect()
    assert all(r["report"].startswith("事件类型: device_status | 设备ID: device-") for r in lines)


def test_observed_counts(spark):
    df, seen = counters.observed(spark.range(100), "n", F.col("id") % 4 == 0)
    assert df.count() == 100
    assert seen.get == {"rows": 100, "ok_rows": 25}


def test_a_null_message_is_a_line_of_the_short_report_only(spark):
    messages = spark.createDataFrame([(1, None), (2, "x")], "n int, value string")
    short = {r["n"]: r["report"] for r in device.report_short(messages, "n").collect()}
    assert short == {1: device.FAILED_SHORT + "null", 2: device.FAILED_SHORT + "x"}
    assert [r["n"] for r in device.report_full(messages, "n").collect()] == [2]
