"""The workloads' inputs, derived from the test tables as column expressions.

Each function maps a whole table to the shape one workload reads: no row is
left out and nothing is generated beside the table's rows. Malformed records
are injected by key arithmetic so that SQL can say which rows are bad without
parsing anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.functions import device, logs

LOG_START_MILLIS = 1704067200000  # 2024-01-01 00:00:00 UTC
LOG_STEP_MILLIS = 250


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _timestamp(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def device_messages(events: DataFrame) -> DataFrame:
    """Queue records with a JSON device event; some cut, without payload, or with a list payload."""
    n = F.col("event_id")
    head = _text('{"event":"device_status","timestamp":', F.unix_millis(_timestamp("ts")))
    payload = _text(',"payload":{"id":"device-', F.col("user_id") + 10000, '","status":"', device.pick_state(n % 4),
                    '","temperature":', n % 15 + 20, ',"voltage":', F.col("value"), "}")
    rest = (
        F.when(n % 23 == 0, payload)
        .when(n % 29 == 0, "}")
        .when(n % 31 == 0, ',"payload":[1]}')
        .otherwise(_text(payload, "}"))
    )
    return events.select(
        F.lit(device.MESSAGE_KEY).alias("key"),
        _text(head, rest).alias("value"),
        F.lit("devices").alias("topic"),
        (n % 4).cast("int").alias("partition"),
        n.alias("offset"),
        _timestamp("ts").alias("timestamp"),
    )


def app_logs(events: DataFrame) -> DataFrame:
    """Seven text columns of application logs plus arrival sequence and time."""
    n = F.col("event_id")
    written = F.timestamp_millis(F.lit(LOG_START_MILLIS) + n * LOG_STEP_MILLIS)
    levels = F.array(*[F.lit(name) for name in logs.SEVERITY])
    return events.select(
        _text("app-", F.col("user_id") % 5).alias("app_name"),
        F.when(n % 37 == 0, F.lit("bad")).otherwise(F.date_format(written, logs.TIME_FORMAT)).alias("time_stamp"),
        _text(" ", F.element_at(levels, (n % 4 + 1).cast("int")), " ").alias("level"),
        F.col("event_type").alias("logger"),
        F.col("props").alias("message"),
        _text("t-", n % 8).alias("thread"),
        F.when(F.col("event_type") == "error", _text("E", F.col("user_id"))).alias("exception"),
        n.alias("seq"),
        _timestamp("ts").alias("arrival_ts"),
    )


def app_log_messages(events: DataFrame) -> DataFrame:
    """The same logs as queue records whose value is the JSON of the seven columns."""
    rows = app_logs(events)
    return rows.select(F.to_json(F.struct(*logs.LOG_FIELDS), {"ignoreNullFields": "false"}).alias("value"),
                       F.col("seq").alias("offset"), F.col("arrival_ts").alias("timestamp"))


def faulty_log_messages(events: DataFrame) -> DataFrame:
    """Queue records of the logs, some of them no JSON or without an application, spread over four partitions."""
    rows = app_logs(events).withColumn("app_name", F.when(F.col("seq") % 43 != 0, F.col("app_name")))
    value = F.to_json(F.struct(*logs.LOG_FIELDS), {"ignoreNullFields": "false"})
    cut = F.when(F.col("seq") % 41 == 0, F.substring(value, F.lit(1), F.length(value) - 1)).otherwise(value)
    return rows.select(cut.alias("value"), F.lit("logs").alias("topic"),
                       (F.col("seq") % 4).cast("int").alias("partition"), F.col("seq").alias("offset"),
                       F.col("arrival_ts").alias("timestamp"))


def repeated_records(events: DataFrame) -> DataFrame:
    """Records with the id they were sent with, in three sendings: each record in one, every seventh also in the next,
    every eleventh twice in its own."""
    n = F.col("event_id")
    first = n % 3
    sendings = F.concat(F.array(first), F.when(n % 7 == 0, F.array(first + 1)).otherwise(F.array().cast("array<long>")),
                        F.when(n % 11 == 0, F.array(first)).otherwise(F.array().cast("array<long>")))
    return events.select(F.concat_ws("-", F.lit("dev-events"), n % 4, n).alias("record_id"),
                         F.col("props").alias("value"), F.explode(sendings).alias("sending"))


def maintenance_config(part: DataFrame) -> DataFrame:
    """One maintenance configuration row per part: the 19 columns read, the activity flag, and status columns."""
    k, size = F.col("p_partkey"), F.col("p_size")
    name = F.when(k % 13 == 0, _text("nodot", k)).otherwise(
        _text("db", k % 7, ".tbl_", k, F.when(k % 11 == 0, F.lit(".x")).otherwise(F.lit(""))))
    return part.select(
        name.alias("full_table_name"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(size % 10 + 1).cast("int").alias("compaction_commit_threshold"),
        (size % 4 + 1).cast("int").alias("spark_executor_cores"),
        _text(size % 8 + 1, "g").alias("spark_executor_memory"),
        F.lit("1g").alias("spark_driver_memory"),
        (size + 5).cast("int").alias("spark_shuffle_partitions"),
        F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("spark_dynamic_allocation"),
        F.when(k % 19 == 0, F.lit(None)).otherwise(F.lit(1)).cast("int").alias("spark_dynamic_min_executors"),
        (size % 10 + 2).cast("int").alias("spark_dynamic_max_executors"),
        F.when(k % 23 == 0, F.lit(None)).otherwise(size % 3 + 1).cast("int").alias("spark_dynamic_initial_executors"),
        (size % 24).cast("string").alias("schedule_hours"),
        F.lit("UTC").alias("schedule_timezone"),
        (k % 5).cast("int").alias("priority_level"),
        F.lit("true").alias("enable_monitoring"),
        F.lit("false").alias("alert_on_failure"),
        F.lit(None).cast("string").alias("alert_recipients"),
        (size % 4).cast("int").alias("max_retry_times"),
        F.col("p_name").alias("remark"),
        F.lit("2024-01-01").alias("load_dt"),
        (F.col("p_type") != "PROMO").alias("is_active"),
        F.lit("2023-12-31 00:00:00").alias("last_compaction_time"),
        F.lit(None).cast("string").alias("last_compaction_status"),
        F.lit(None).cast("string").alias("yarn_application_id"),
        F.lit("2023-12-31 00:00:00").alias("updated_time"),
        F.col("p_brand").alias("updated_by"),
    )


def run_outcomes(part: DataFrame) -> DataFrame:
    """The outcome of one maintenance run per configured table; every third table ran twice."""
    k = F.col("p_partkey")
    runs = F.when(k % 3 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    named = part.withColumn("run", F.explode(runs)).select(
        _text("db", k % 7).alias("schema_name"),
        _text("tbl_", k, F.when(k % 11 == 0, F.lit(".x")).otherwise(F.lit(""))).alias("table_name"),
        F.col("run"),
        F.when((k + F.col("run")) % 10 == 9, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        _text("application_", F.lit(1700000000000) + k, "_", F.lpad((F.col("run") + k % 1000).cast("string"), 4, "0"))
        .alias("application_id"),
    )
    return named.withColumn("application_id", F.when(F.col("status") == "SUCCESS", F.col("application_id")))


def run_log_lines(part: DataFrame) -> DataFrame:
    """Output (rank 0) and error (rank 1) lines of each run; some runs never name their application."""
    k = F.col("p_partkey")
    number = (k % 20000).cast("string")
    padded = F.lpad(number, F.greatest(F.lit(4), F.length(number)), F.lit("0"))
    app = _text("application_", F.lit(1700000000000) + k, "_", padded)
    other = _text("application_", F.lit(1600000000000) + k, "_0001")

    def line(rank: int, no: int, text: Column) -> Column:
        return F.struct(F.lit(rank).alias("file_rank"), F.lit(no).alias("line_no"), text.alias("line"))

    lines = F.array(
        line(0, 1, F.lit("starting")),
        line(0, 2, F.when(k % 4 == 0, _text("submitted ", app, " to the cluster")).otherwise(F.lit("submitting"))),
        line(0, 3, F.lit("application_17_1 is not an id")),
        line(1, 1, F.when(k % 4 <= 1, _text("tracking ", other)).otherwise(F.lit("warming up"))),
        line(1, 2, F.when(k % 4 <= 2, _text("report for ", app, ", and for ", other)).otherwise(F.lit("no report"))),
        line(1, 3, F.lit("done")),
    )
    return part.select(k.alias("run_id"), F.inline(lines))


def lake_base(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("record_key"), F.col("c_acctbal").alias("amount"),
        F.lit(None).cast("string").alias("commit"), F.lit(-1).cast("long").alias("seq"))


def lake_log(orders: DataFrame) -> DataFrame:
    n = F.col("o_orderkey")
    return orders.select(
        F.col("o_custkey").alias("record_key"), F.col("o_totalprice").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("commit"), n.alias("seq"),
        (n % 19 == 0).alias("is_delete"))


def file_versions(lineitem: DataFrame) -> DataFrame:
    """Versions of file groups: one table per supplier, one commit per month."""
    return lineitem.select(
        F.col("l_suppkey").alias("table_id"),
        (F.col("l_partkey") % 20).alias("file_group"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("long").alias("commit"),
    ).distinct()


def table_thresholds(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("table_id"),
                           (F.col("s_suppkey") % 40 + 1).alias("compaction_commit_threshold"))


def settings_defaults(supplier: DataFrame) -> DataFrame:
    """Cluster settings, one per (cluster, role, key): the topic is NULL."""
    n = F.col("s_suppkey")
    rows = supplier.select(
        _text("c", F.col("s_nationkey")).alias("cluster"),
        F.element_at(F.array(F.lit("server"), F.lit("producer"), F.lit("consumer")), (n % 3 + 1).cast("int"))
        .alias("role"),
        _text("k", n % 10).alias("key"), n.alias("n"))
    return rows.groupBy("cluster", "role", "key").agg(F.max("n").cast("string").alias("value")).select(
        "cluster", F.lit(None).cast("string").alias("topic"), "role", "key", "value")


def settings_overrides(customer: DataFrame) -> DataFrame:
    """Topic settings, one per (cluster, topic, role, key)."""
    n = F.col("c_custkey")
    rows = customer.select(
        _text("c", F.col("c_nationkey")).alias("cluster"),
        _text("t", F.floor(n / 100)).alias("topic"),
        F.element_at(F.array(F.lit("producer"), F.lit("consumer")), (n % 2 + 1).cast("int")).alias("role"),
        _text("k", n % 13).alias("key"), n.alias("n"))
    return rows.groupBy("cluster", "topic", "role", "key").agg(F.max("n").cast("string").alias("value"))


def allowed_keys(spark: SparkSession) -> DataFrame:
    """The key whitelist of the test settings: k0 to k11 for both client roles."""
    keys = spark.range(12).select(_text("k", F.col("id")).alias("key"))
    return keys.select(F.explode(F.array(F.lit("producer"), F.lit("consumer"))).alias("role"), "key")


def settings_requests(orders: DataFrame) -> DataFrame:
    """One lookup per order; some name clusters or topics that do not exist."""
    return orders.select(
        F.col("o_orderkey").alias("request_id"),
        _text("c", F.col("o_orderkey") % 30).alias("cluster"),
        _text("t", F.floor(F.col("o_custkey") / 100)).alias("topic"))


def document_lines(documents: DataFrame) -> DataFrame:
    """Every line of every document as a log line of its own file."""
    path = _text("/logs/", F.col("source"), "/", F.col("doc_id"), ".log")
    return documents.select(path.alias("file"), F.posexplode(F.split("text", "\n", -1))).select(
        "file", (F.col("pos") + 1).cast("long").alias("line_no"), F.col("col").alias("value"))
