"""All registered queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from penstock.plans import (device_queries, lake_queries, log_queries, maintenance_queries, settings_queries,
                            stream_queries)
from penstock.session import apply_runtime_conf

FAMILIES = [device_queries, log_queries, maintenance_queries, lake_queries, settings_queries, stream_queries]


def _pinned(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(apply_runtime_conf(spark), sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _pinned(query) for family in FAMILIES for name, query in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.ORACLE.items()}
