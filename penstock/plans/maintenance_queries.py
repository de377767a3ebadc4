"""Lake maintenance driven by a config table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from penstock.operators import maintenance
from penstock.plans import fixtures
from penstock.plans.fixture_sql import CONFIG, with_parts
from penstock.session import fresh_folder
from penstock.sources import delimited

AS_OF = "2024-02-01 12:00:00"


# Integers that may be NULL are shown as text, since data frames of different engines hold them differently.
MAY_BE_NULL = ["compaction_commit_threshold", "spark_dynamic_min_executors", "spark_dynamic_initial_executors",
               "min_executors", "max_executors", "initial_executors", "executor_instances"]


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in MAY_BE_NULL if c in df.columns})


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "part")


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.active_config(fixtures.maintenance_config(_part(spark, sf_dir)))


def config_active_ordered(spark, sf_dir):
    """The active rows in run order, selected through a view as a scheduled job would."""
    config = fixtures.maintenance_config(_part(spark, sf_dir))
    columns = ", ".join(maintenance.CONFIG_COLUMNS)
    return _shown(spark.sql(
        f"SELECT {columns} FROM {{config}} WHERE is_active ORDER BY priority_level ASC, full_table_name ASC",
        config=config))


def config_preview(spark, sf_dir):
    """The number of active rows and the first three in run order."""
    active = _active(spark, sf_dir)
    rank = F.row_number().over(Window.orderBy("priority_level", "full_table_name"))
    first = maintenance.preview(active).select(F.concat(F.lit("row "), rank.cast("string")).alias("item"),
                                               F.col("full_table_name").alias("value"))
    count = active.agg(F.count("*").cast("string").alias("value")).select(F.lit("rows").alias("item"), "value")
    return first.unionByName(count)


def config_parsed(spark, sf_dir):
    parsed = maintenance.parsed_config(_active(spark, sf_dir))
    return _shown(parsed.withColumn("pipe_line", maintenance.pipe_line()))


def config_files(spark, sf_dir):
    """The same through files: exported with tabs, read back, parsed, written with pipes, read back."""
    export, rows = fresh_folder(spark, "config-tsv"), fresh_folder(spark, "config-pipe")
    delimited.write_tsv(maintenance.by_priority(_active(spark, sf_dir)), export)
    exported = delimited.read_tsv(spark, export, maintenance.CONFIG_SCHEMA)
    delimited.write_pipe(maintenance.parsed_config(exported), rows)
    return _shown(delimited.read_pipe(spark, rows, maintenance.PARSED_SCHEMA))


def config_rejected(spark, sf_dir):
    rejected = maintenance.rejected_config(_active(spark, sf_dir))
    return _shown(rejected.select("full_table_name", "compaction_commit_threshold", "reason"))


def compaction_params(spark, sf_dir):
    parsed = maintenance.parsed_config(_active(spark, sf_dir))
    return _shown(maintenance.with_upkeep_limits(parsed).select(
        "full_table_name", "compaction_commit_threshold", "commits_retained", "keep_min", "keep_max"))


def resource_plan(spark, sf_dir):
    parsed = maintenance.parsed_config(_active(spark, sf_dir))
    return _shown(maintenance.with_resources(parsed).select(
        "full_table_name", "dynamic", "min_executors", "max_executors", "initial_executors", "executor_instances",
        "spark_executor_cores", "spark_executor_memory", "spark_driver_memory", "spark_shuffle_partitions"))


def maintenance_status(spark, sf_dir):
    part = _part(spark, sf_dir)
    after = maintenance.with_status(fixtures.maintenance_config(part), fixtures.run_outcomes(part),
                                    as_of=F.lit(AS_OF).cast("timestamp"))
    return after.select("full_table_name", "schema_name", "table_name", "last_compaction_time",
                        "last_compaction_status", "yarn_application_id", "updated_time", "updated_by")


def maintenance_summary(spark, sf_dir):
    return maintenance.run_summary(fixtures.run_outcomes(_part(spark, sf_dir)))


def app_id_extract(spark, sf_dir):
    return maintenance.application_ids(fixtures.run_log_lines(_part(spark, sf_dir)))


QUERIES = {f.__name__: f for f in [
    config_active_ordered, config_preview, config_parsed, config_files, config_rejected, compaction_params,
    resource_plan, maintenance_status, maintenance_summary, app_id_extract,
]}


def _columns(names: list[str]) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in MAY_BE_NULL else c for c in names)


_CONFIG_19 = _columns(maintenance.CONFIG_COLUMNS)
_PARSED_12 = _columns(maintenance.PARSED_COLUMNS)
_PIPE = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in maintenance.PARSED_COLUMNS)

ORACLE = {
    "config_active_ordered": with_parts(f"SELECT {_CONFIG_19} FROM active", CONFIG),
    "config_preview": with_parts("""
SELECT 'row ' || CAST(n AS VARCHAR) AS item, full_table_name AS value
FROM (SELECT full_table_name, row_number() OVER (ORDER BY priority_level, full_table_name) AS n FROM active)
WHERE n <= 3
UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM active""", CONFIG),
    "config_parsed": with_parts(f"SELECT {_PARSED_12}, {_PIPE} AS pipe_line FROM runnable", CONFIG),
    "config_files": with_parts(f"SELECT {_PARSED_12} FROM runnable", CONFIG),
    "config_rejected": with_parts("""
SELECT full_table_name, CAST(compaction_commit_threshold AS VARCHAR) AS compaction_commit_threshold,
  CASE WHEN schema_name IS NULL THEN 'invalid table name' ELSE 'missing threshold' END AS reason
FROM active WHERE schema_name IS NULL OR compaction_commit_threshold IS NULL""", CONFIG),
    "compaction_params": with_parts("""
SELECT full_table_name, CAST(compaction_commit_threshold AS VARCHAR) AS compaction_commit_threshold,
  compaction_commit_threshold * 2 AS commits_retained,
  compaction_commit_threshold * 2 + 1 AS keep_min, compaction_commit_threshold * 2 + 21 AS keep_max
FROM runnable""", CONFIG),
    "resource_plan": with_parts("""
SELECT full_table_name, k % 2 = 0 AS dynamic,
  CAST(CASE WHEN k % 2 = 0 THEN coalesce(spark_dynamic_min_executors, 1) END AS VARCHAR) AS min_executors,
  CAST(CASE WHEN k % 2 = 0 THEN spark_dynamic_max_executors END AS VARCHAR) AS max_executors,
  CAST(CASE WHEN k % 2 = 0 THEN coalesce(spark_dynamic_initial_executors, 1) END AS VARCHAR) AS initial_executors,
  CASE WHEN k % 2 <> 0 THEN '2' END AS executor_instances,
  spark_executor_cores, spark_executor_memory, spark_driver_memory, spark_shuffle_partitions
FROM runnable""", CONFIG),
    "maintenance_status": with_parts(f"""
SELECT c.full_table_name, c.schema_name, c.table_name,
  CASE WHEN o.k IS NOT NULL THEN '{AS_OF}' ELSE '2023-12-31 00:00:00' END AS last_compaction_time,
  o.status AS last_compaction_status,
  CASE WHEN o.k IS NOT NULL THEN coalesce(o.application_id, '') END AS yarn_application_id,
  CASE WHEN o.k IS NOT NULL THEN '{AS_OF}' ELSE '2023-12-31 00:00:00' END AS updated_time,
  CASE WHEN o.k IS NOT NULL THEN 'SYSTEM_AUTO' ELSE c.p_brand END AS updated_by
FROM config c LEFT JOIN outcome o
  ON c.k = o.k AND c.schema_name IS NOT NULL AND o.run = CASE WHEN c.k % 3 = 0 THEN 2 ELSE 1 END""", CONFIG),
    "maintenance_summary": with_parts("""
SELECT count(*) AS total, count(*) FILTER (status = 'SUCCESS') AS succeeded, count(*) FILTER (status = 'FAILED') AS failed,
  count(*) FILTER (status = 'FAILED') = 0 AS all_ok FROM outcome""", CONFIG),
    "app_id_extract": """
SELECT p_partkey AS run_id, CASE p_partkey % 4
    WHEN 0 THEN 'application_' || CAST(1700000000000 + p_partkey AS VARCHAR) || '_' || app_no
    WHEN 1 THEN 'application_' || CAST(1600000000000 + p_partkey AS VARCHAR) || '_0001'
    WHEN 2 THEN 'application_' || CAST(1700000000000 + p_partkey AS VARCHAR) || '_' || app_no END AS application_id
FROM (SELECT p_partkey, CASE WHEN p_partkey % 20000 < 10000 THEN right('0000' || CAST(p_partkey % 20000 AS VARCHAR), 4)
        ELSE CAST(p_partkey % 20000 AS VARCHAR) END AS app_no FROM part)""",
}
