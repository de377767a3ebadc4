"""Config-table-driven maintenance: pick tables, derive parameters, plan resources, record status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.operators import lake
from penstock.operators.keyed import first_match, latest_per_key

# The columns read, the columns passed on, patterns and marks.
CONFIG_SCHEMA = T.StructType([
    T.StructField("full_table_name", T.StringType()),
    T.StructField("compaction_commit_threshold", T.IntegerType()),
    T.StructField("spark_executor_cores", T.IntegerType()),
    T.StructField("spark_executor_memory", T.StringType()),
    T.StructField("spark_driver_memory", T.StringType()),
    T.StructField("spark_shuffle_partitions", T.IntegerType()),
    T.StructField("spark_dynamic_allocation", T.StringType()),
    T.StructField("spark_dynamic_min_executors", T.IntegerType()),
    T.StructField("spark_dynamic_max_executors", T.IntegerType()),
    T.StructField("spark_dynamic_initial_executors", T.IntegerType()),
    T.StructField("schedule_hours", T.StringType()),
    T.StructField("schedule_timezone", T.StringType()),
    T.StructField("priority_level", T.IntegerType()),
    T.StructField("enable_monitoring", T.StringType()),
    T.StructField("alert_on_failure", T.StringType()),
    T.StructField("alert_recipients", T.StringType()),
    T.StructField("max_retry_times", T.IntegerType()),
    T.StructField("remark", T.StringType()),
    T.StructField("load_dt", T.StringType()),
])
CONFIG_COLUMNS = CONFIG_SCHEMA.fieldNames()
PARSED_COLUMNS = [
    "schema_name", "table_name", "full_table_name", "compaction_commit_threshold", "spark_executor_cores",
    "spark_executor_memory", "spark_driver_memory", "spark_dynamic_allocation", "spark_dynamic_min_executors",
    "spark_dynamic_max_executors", "spark_dynamic_initial_executors", "spark_shuffle_partitions",
]
PARSED_SCHEMA = T.StructType([
    CONFIG_SCHEMA[name] if name in CONFIG_COLUMNS else T.StructField(name, T.StringType())
    for name in PARSED_COLUMNS
])
QUALIFIED_NAME_PATTERN = r"^([^.]+)\.(.+)$"
APPLICATION_ID_PATTERN = r"application_[0-9]{13}_[0-9]{4,}"
SUCCESS, FAILED = "SUCCESS", "FAILED"
UPDATED_BY = "SYSTEM_AUTO"
FIXED_EXECUTORS = 2
PREVIEW_ROWS = 3
ERROR_TAIL_LINES = 5

BAD_NAME = "invalid table name"
NO_THRESHOLD = "missing threshold"


def _has_text(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name).cast("string") != "")


def active_config(config: DataFrame) -> DataFrame:
    """The 19 columns of active rows."""
    return config.where("is_active").select(*CONFIG_COLUMNS)


def by_priority(config: DataFrame) -> DataFrame:
    """Most urgent first; the name makes the order total."""
    return config.orderBy(F.col("priority_level").asc(), F.col("full_table_name").asc())


def preview(config: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows in run order: a top-k, not a sort of the whole table."""
    return by_priority(config).limit(rows)


def has_rows(df: DataFrame) -> bool:
    """The gate before a run: at least one row, found without counting all."""
    return not df.isEmpty()


def with_names(config: DataFrame) -> DataFrame:
    """Schema and table name: as the table stores them, else the full name split at the first dot.

    NULL where neither is there.
    """
    def part(i: int, stored: str) -> Column:
        valid = F.col("full_table_name").rlike(QUALIFIED_NAME_PATTERN)
        split = F.when(valid, F.regexp_extract("full_table_name", QUALIFIED_NAME_PATTERN, i))
        return F.coalesce(F.col(stored), split) if stored in config.columns else split
    return config.withColumns({"schema_name": part(1, "schema_name"), "table_name": part(2, "table_name")})


def reject_reason() -> Column:
    """Why a named config row cannot run, NULL when it can."""
    return (
        F.when(F.col("schema_name").isNull(), F.lit(BAD_NAME))
        .when(~_has_text("compaction_commit_threshold"), F.lit(NO_THRESHOLD))
    )


def parsed_config(config: DataFrame) -> DataFrame:
    """Runnable rows in the 12-column form."""
    return with_names(config).where(reject_reason().isNull()).select(*PARSED_COLUMNS)


def rejected_config(config: DataFrame) -> DataFrame:
    """The other rows, with the reason."""
    return with_names(config).withColumn("reason", reject_reason()).where("reason is not null")


def pipe_line(columns: list[str] | None = None) -> Column:
    """The row as one ``|``-separated text; a NULL leaves its place empty."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (columns or PARSED_COLUMNS)]
    return F.concat_ws("|", *cells)


def with_upkeep_limits(config: DataFrame, threshold: str = "compaction_commit_threshold") -> DataFrame:
    """Commits to keep for cleaning, and the two archive bounds."""
    t = F.col(threshold)
    return (
        config.withColumn("commits_retained", lake.clean_limit(t))
        .withColumn("keep_min", lake.archive_min(t))
        .withColumn("keep_max", lake.archive_max(t))
    )


def with_resources(config: DataFrame) -> DataFrame:
    """Executor plan: a min/max/initial range when dynamic is exactly ``true``, else a fixed number."""
    dynamic = F.coalesce(F.col("spark_dynamic_allocation") == "true", F.lit(False))

    def when_dynamic(name: str, default: int) -> Column:
        return F.when(dynamic, F.coalesce(F.col(name), F.lit(default)))

    return (
        config.withColumn("dynamic", dynamic)
        .withColumn("min_executors", when_dynamic("spark_dynamic_min_executors", 1))
        .withColumn("max_executors", when_dynamic("spark_dynamic_max_executors", FIXED_EXECUTORS))
        .withColumn("initial_executors", when_dynamic("spark_dynamic_initial_executors", 1))
        .withColumn("executor_instances", F.when(~dynamic, F.lit(FIXED_EXECUTORS)))
    )


def application_ids(lines: DataFrame, run: str = "run_id") -> DataFrame:
    """The first application id in each run's lines, output file before error file."""
    found = F.regexp_extract("line", APPLICATION_ID_PATTERN, 0)
    return first_match(lines, [run], found, ["file_rank", "line_no"]).withColumnRenamed("match", "application_id")


def with_status(config: DataFrame, outcomes: DataFrame, as_of: Column | None = None,
                run_order: str = "run") -> DataFrame:
    """The config table after the runs: status columns replaced where a run happened.

    A table that ran more than once takes its last run; a table that did not
    run keeps its row. A run without an application id leaves an empty id.
    """
    last = latest_per_key(outcomes, ["schema_name", "table_name"], [run_order]).select(
        "schema_name", "table_name", F.col("status").alias("_status"), F.col("application_id").alias("_app"))
    ran = F.col("_status").isNotNull()
    now = F.date_format(F.current_timestamp() if as_of is None else as_of, "yyyy-MM-dd HH:mm:ss")
    stamps = {
        "last_compaction_time": now,
        "last_compaction_status": F.col("_status"),
        "yarn_application_id": F.coalesce(F.col("_app"), F.lit("")),
        "updated_time": now,
        "updated_by": F.lit(UPDATED_BY),
    }
    joined = with_names(config).join(last, ["schema_name", "table_name"], "left")
    return joined.select(*[
        F.when(ran, stamps[c]).otherwise(F.col(c)).alias(c) if c in stamps else F.col(c)
        for c in dict.fromkeys(["schema_name", "table_name", *config.columns])
    ])


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Totals of a run and whether nothing failed."""
    return outcomes.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == SUCCESS).alias("succeeded"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
    ).withColumn("all_ok", F.col("failed") == 0)
