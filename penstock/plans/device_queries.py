"""Device stream: reports, quarantine, serialising, generating."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.functions import device
from penstock.operators import counters
from penstock.plans import fixtures
from penstock.plans.fixture_sql import DEVICE, with_parts
from penstock.sources import generator, kafka

PLACE = ["partition", "offset"]


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.device_messages(fixtures.table(spark, sf_dir, "events"))


def device_report_full(spark, sf_dir):
    return device.report_full(_messages(spark, sf_dir), *PLACE)


def device_report_short(spark, sf_dir):
    return device.report_short(_messages(spark, sf_dir), *PLACE)


def device_client_report(spark, sf_dir):
    return device.report_client(_messages(spark, sf_dir), *PLACE)


def device_quarantine(spark, sf_dir):
    return device.quarantine(_messages(spark, sf_dir), *PLACE)


def device_serialize(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    text = device.event_json(
        F.col("event_type"), F.unix_millis(F.col("ts").cast("timestamp")), id=F.col("user_id"),
        name=F.concat(F.lit('dev "'), F.col("user_id").cast("string"), F.lit('"')), status=F.col("event_type"))
    return events.select("event_id", *device.keyed_message(text))


def device_generate(spark, sf_dir):
    """One generated record per event, numbered by its id; random fields as range checks."""
    events = fixtures.table(spark, sf_dir, "events")
    made = events.select(*generator.device_fields(F.col("event_id"), F.col("ts").cast("timestamp"), seed=7))
    parsed = device.parse_events(generator.as_message(made))
    p = "parsed.payload."
    t, v = F.col(p + "temperature").cast("int"), F.col(p + "voltage").cast("double")
    return parsed.select(
        "n", F.col("parsed.event").alias("event"), F.col(p + "id").alias("id"),
        F.col(p + "status").isin(device.DEVICE_STATES).alias("status_ok"),
        t.between(20, 34).alias("temperature_ok"),
        ((v >= 3.5) & (v < 5.0)).alias("voltage_ok"),
        counters.is_progress_mark(F.col("n") + 1).alias("progress"))


def props_parse(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    return device.json_keys(events, "props", "k", keep=["event_id"])


def record_repeats(spark, sf_dir):
    """Records delivered twice, as an at-least-once sink may do, and dropped again by their id."""
    sent = kafka.outgoing(kafka.with_record_id(_messages(spark, sf_dir)))
    twice = sent.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    return kafka.drop_repeats(kafka.with_sent_id(twice)).select("record_id", "value")


QUERIES = {f.__name__: f for f in [
    device_report_full, device_report_short, device_client_report, device_quarantine, device_serialize,
    device_generate, props_parse, record_repeats,
]}

ORACLE = {
    "device_report_full": with_parts("""
SELECT "partition", "offset", CASE kind WHEN 'good' THEN
    '事件类型: device_status | 设备ID: ' || id || ' | 状态: ' || status || ' | 温度: ' || temperature || '℃ | 电压: ' || voltage || 'V'
  ELSE '解析失败: ' || left(value, 100) || '...' END AS report
FROM message""", DEVICE),
    "device_report_short": with_parts("""
SELECT "partition", "offset", CASE kind WHEN 'good' THEN '事件:device_status | 设备ID:' || id || ' | 状态:' || status
  ELSE 'JSON解析失败: ' || value END AS report
FROM message""", DEVICE),
    "device_client_report": with_parts("""
SELECT "partition", "offset", chr(10) || '[Consumer] 收到JSON消息 → 分区:' || CAST("partition" AS VARCHAR) || ' 偏移量:'
  || CAST("offset" AS VARCHAR) || chr(10) || '  事件:device_status' || chr(10) || '  设备ID:' || id || chr(10)
  || '  状态:' || status || chr(10) AS report
FROM message WHERE kind = 'good'""", DEVICE),
    "device_quarantine": with_parts("""
SELECT "partition", "offset", value,
  CASE kind WHEN 'cut' THEN 'invalid json' WHEN 'bare' THEN 'payload missing' ELSE 'payload not an object' END AS reason,
  '解析失败: ' || left(value, 100) || '...' AS excerpt_text, 'JSON解析失败: ' || value AS whole_text
FROM message WHERE kind <> 'good'""", DEVICE),
    "device_serialize": """
SELECT event_id, 'json-key' AS key, '{"event":"' || event_type || '","timestamp":' || CAST(epoch_us(ts) // 1000 AS VARCHAR)
  || ',"payload":{"id":' || CAST(user_id AS VARCHAR) || ',"name":"dev \\"' || CAST(user_id AS VARCHAR)
  || '\\"","status":"' || event_type || '"}}' AS value
FROM events""",
    "device_generate": """
SELECT event_id AS n, 'device_status' AS event, 'device-' || CAST(event_id + 10000 AS VARCHAR) AS id,
  true AS status_ok, true AS temperature_ok, true AS voltage_ok, (event_id + 1) % 10 = 0 AS progress
FROM events""",
    "props_parse": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "record_repeats": with_parts("""
SELECT 'devices-' || CAST("partition" AS VARCHAR) || '-' || CAST("offset" AS VARCHAR) AS record_id, value
FROM message""", DEVICE),
}
