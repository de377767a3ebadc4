"""The maintenance run: tables one after another in config order, a failure never stops the rest.

Each table's work is Spark jobs; the driver only walks the plan (one row per
table, streamed, never collected) and notes one outcome per table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

from penstock.operators import maintenance
from penstock.sources import folders
from penstock.streaming.lake_table import LakeTable

OUTCOME_SCHEMA = "schema_name string, table_name string, run long, status string, application_id string, error string"
FLUSH_EVERY = 100


def run_plan(config: DataFrame, body: Callable[[Row], object], outcomes_path: str) -> DataFrame:
    """Run ``body`` for every runnable config row, most urgent first; returns the outcomes.

    Outcomes are written every few tables, so those of finished tables survive
    the driver. Each run has a folder of its own below ``outcomes_path``.
    """
    outcomes_path = f"{outcomes_path}/run={uuid.uuid4().hex}"
    spark = config.sparkSession
    named = maintenance.with_upkeep_limits(maintenance.with_names(config))
    plan = maintenance.by_priority(named.where(maintenance.reject_reason().isNull()))
    app = spark.sparkContext.applicationId
    pending: list[tuple] = []
    chunk = 0

    def flush() -> None:
        nonlocal chunk
        spark.createDataFrame(pending, OUTCOME_SCHEMA).write.mode("overwrite").parquet(f"{outcomes_path}/chunk={chunk}")
        pending.clear()
        chunk += 1

    for run, row in enumerate(plan.toLocalIterator(), start=1):
        try:
            body(row)
            outcome = (maintenance.SUCCESS, app, None)
        except Exception as error:  # noqa: BLE001 - one table's failure must not stop the others
            outcome = (maintenance.FAILED, None, str(error))
        pending.append((row["schema_name"], row["table_name"], run, *outcome))
        if len(pending) >= FLUSH_EVERY:
            flush()
    flush()
    return spark.read.schema(OUTCOME_SCHEMA).parquet(f"{outcomes_path}/chunk=*")


def record_status(spark: SparkSession, config_path: str, outcomes: DataFrame, **options) -> int:
    """Write the config table's next version with the outcomes' status."""
    config = folders.read_newest(spark, config_path)
    return folders.write_next(maintenance.with_status(config, outcomes, **options).select(*config.columns), config_path)


def table_upkeep(table_of: Callable[[Row], LakeTable]) -> Callable[[Row], None]:
    """Compact, clean and archive a table of this package, in this order."""
    def body(row: Row) -> None:
        table = table_of(row)
        table.compact()
        table.clean(row["commits_retained"])
        table.archive(row["keep_min"], row["keep_max"])
    return body


def statement_upkeep(spark: SparkSession) -> Callable[[Row], None]:
    """The same for tables of a deployed lakehouse format, which does the work itself."""
    def body(row: Row) -> None:
        for statement in upkeep_statements(row):
            spark.sql(statement)
    return body


def upkeep_statements(row: Row) -> list[str]:
    """Settings and commands for one table, inline and in order: compact, clean, archive."""
    table = row["full_table_name"]
    if not re.fullmatch(r"[^\s;'\"`]+", table):
        raise ValueError(f"not a table name: {table!r}")
    # The format's setting names and commands.
    settings = {
        "hoodie.compact.inline": "true",
        "hoodie.run.compact.only.inline": "true",
        "hoodie.cleaner.commits.retained": row["commits_retained"],
        "hoodie.keep.max.commits": row["keep_max"],
        "hoodie.keep.min.commits": row["keep_min"],
        "hoodie.clean.async": "false",
        "hoodie.clean.automatic": "false",
        "hoodie.archive.async": "false",
        "hoodie.archive.automatic": "false",
    }
    commands = [f"run {step} on {table}" for step in ("compaction", "clean", "archivelog")]
    return [f"set {key} = {value}" for key, value in settings.items()] + commands
