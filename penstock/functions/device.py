"""Device-event columns: parse, report, isolate, serialise.

Every function is a built-in column expression, so the same transform runs
inside whole-stage codegen on a batch frame and on a stream, with no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Message texts and state names that results must equal.
REPORT_FULL = "事件类型: %s | 设备ID: %s | 状态: %s | 温度: %s℃ | 电压: %sV"
REPORT_SHORT = "事件:%s | 设备ID:%s | 状态:%s"
REPORT_CLIENT = "\n[Consumer] 收到JSON消息 → 分区:%d 偏移量:%d\n  事件:%s\n  设备ID:%s\n  状态:%s\n"
FAILED_FULL = "解析失败: "
FAILED_SHORT = "JSON解析失败: "
FAILED_EXCERPT_CHARS = 100
DEVICE_STATES = ["online", "offline", "warning", "error"]
PRINT_PREFIX = "处理结果: "
MESSAGE_KEY = "json-key"

# Why a message was set aside.
NULL_MESSAGE = "null message"
INVALID_JSON = "invalid json"
PAYLOAD_MISSING = "payload missing"
PAYLOAD_NOT_OBJECT = "payload not an object"

CORRUPT = "_corrupt_record"

JSON_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_schema(*payload: str) -> T.StructType:
    """Schema with the payload fields asked for.

    Leaves are strings: an id may be a number or a text. Fields nobody reads
    stay out (they cannot make a row invalid, and each costs parsing time).
    """
    fields = [T.StructField(name, T.StringType()) for name in payload]
    return T.StructType([
        T.StructField("event", T.StringType()),
        T.StructField("payload", T.StructType(fields)),
        T.StructField(CORRUPT, T.StringType()),
    ])


def parse_events(df: DataFrame, *payload: str, value: str = "value") -> DataFrame:
    """Add ``parsed`` (the event struct) and ``ok`` (parsed, and payload is an object)."""
    schema = event_schema(*(payload or ("id", "status", "temperature", "voltage")))
    parsed = df.withColumn("parsed", once(F.from_json(F.col(value), schema, JSON_OPTIONS)))
    ok = F.col("parsed.payload").isNotNull() & F.col(f"parsed.{CORRUPT}").isNull()
    return parsed.withColumn("ok", ok)


def once(costly: Column) -> Column:
    """The same value, computed once per row.

    A filter on a parsed field would otherwise be pushed below the parse and
    repeat it for each field it names; it is not pushed below a generator.
    """
    return F.explode(F.array(costly))


def json_keys(df: DataFrame, text: str, *keys: str, keep: Sequence[str] = ()) -> DataFrame:
    """Top-level keys of a JSON object text as string columns."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    return df.select(*keep, once(F.from_json(F.col(text), schema)).alias("_object")).select(*keep, "_object.*")


def fill(template: str, *cells: str) -> Column:
    """A template's places filled with columns; an absent value prints ``null``.

    A concatenation, as a formatter per row costs a sixth of the whole report.
    """
    texts = [F.lit(t) for t in re.split("%[sd]", template)]
    values = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cells]
    return F.concat(texts[0], *[x for pair in zip(values, texts[1:], strict=True) for x in pair])


def full_report() -> Column:
    """Five-field line of a parsed event."""
    p = "parsed.payload."
    return fill(REPORT_FULL, "parsed.event", p + "id", p + "status", p + "temperature", p + "voltage")


def short_report() -> Column:
    """Three-field line of a parsed event."""
    return fill(REPORT_SHORT, "parsed.event", "parsed.payload.id", "parsed.payload.status")


def client_report(partition: str = "partition", offset: str = "offset") -> Column:
    """Multi-line text with the record's position in its topic."""
    return fill(REPORT_CLIENT, partition, offset, "parsed.event", "parsed.payload.id", "parsed.payload.status")


def failed_excerpt(value: Column | str = "value") -> Column:
    """Failure text with the start of the message; the dots always follow."""
    return F.concat(F.lit(FAILED_FULL), F.substring(_col(value), 1, FAILED_EXCERPT_CHARS), F.lit("..."))


def failed_whole(value: Column | str = "value") -> Column:
    """Failure text with the whole message."""
    return F.concat(F.lit(FAILED_SHORT), _col(value))


def with_failure_reason(bad: DataFrame, value: str = "value") -> DataFrame:
    """Add ``reason``: why each of these bad messages is bad."""
    schema = T.StructType([T.StructField("payload", T.StringType()), T.StructField(CORRUPT, T.StringType())])
    parsed = bad.withColumn("_envelope", once(F.from_json(F.col(value), schema, JSON_OPTIONS)))
    unreadable = (F.col("_envelope").isNull() | F.col(f"_envelope.{CORRUPT}").isNotNull()
                  | (F.trim(F.col(value)) == ""))
    reason = (
        F.when(F.col(value).isNull(), F.lit(NULL_MESSAGE))
        .when(unreadable, F.lit(INVALID_JSON))
        .when(F.col("_envelope.payload").isNull(), F.lit(PAYLOAD_MISSING))
        .otherwise(F.lit(PAYLOAD_NOT_OBJECT))
    )
    return parsed.withColumn("reason", reason).drop("_envelope")


def report_full(messages: DataFrame, *keep: str) -> DataFrame:
    """One line per message: the five-field report, or the failure excerpt.

    A null message has no text to show and goes to quarantine only.
    """
    parsed = parse_events(messages.where(F.col("value").isNotNull()))
    return parsed.select(*keep, F.when(F.col("ok"), full_report()).otherwise(failed_excerpt()).alias("report"))


def report_short(messages: DataFrame, *keep: str) -> DataFrame:
    """One line per message: the three-field report, or the failure with the whole text, which is ``null`` for none."""
    parsed = parse_events(messages, "id", "status")
    failed = failed_whole(F.coalesce("value", F.lit("null")))
    return parsed.select(*keep, F.when(F.col("ok"), short_report()).otherwise(failed).alias("report"))


def report_client(messages: DataFrame, *keep: str) -> DataFrame:
    """The client text for readable messages only; the others appear in quarantine."""
    parsed = parse_events(messages, "id", "status")
    return parsed.where("ok").select(*keep, client_report().alias("report"))


def quarantine(messages: DataFrame, *keep: str) -> DataFrame:
    """Unreadable messages with reason, raw text and both failure texts."""
    bad = parse_events(messages, "id").where(~F.col("ok"))
    return with_failure_reason(bad).select(*keep, "value", "reason", failed_excerpt().alias("excerpt_text"),
                                           failed_whole().alias("whole_text"))


def event_json(event: Column, timestamp: Column, **payload: Column) -> Column:
    """``{"event":…,"timestamp":…,"payload":{…}}`` with keys in the given order."""
    body = F.struct(*[c.alias(k) for k, c in payload.items()])
    return F.to_json(F.struct(event.alias("event"), timestamp.alias("timestamp"), body.alias("payload")))


def keyed_message(value: Column, key: str = MESSAGE_KEY) -> list[Column]:
    """Key and value columns of an outgoing message; all share one routing key by default."""
    return [F.lit(key).alias("key"), value.alias("value")]


def pick_state(index: Column) -> Column:
    """The device state at a zero-based index."""
    return F.element_at(F.array(*[F.lit(s) for s in DEVICE_STATES]), (index + 1).cast("int"))
