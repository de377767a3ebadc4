"""Merge-on-read and version upkeep as relational operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penstock.operators.keyed import latest_per_key


def merge_on_read(base: DataFrame, log: DataFrame, keys: Sequence[str], order: Sequence[str],
                  is_delete: str | None = None, log_has_repeats: bool = True) -> DataFrame:
    """Base rows under the newest log row per key; deleted keys disappear.

    A log row is newer than the base row of its key: the base is what earlier
    log rows were folded into. So a base row stays exactly when no log row has
    its key, and the base needs neither ranking nor, while the log's keys are
    small enough for Spark to broadcast, a shuffle. (One outer join would read
    the log once instead of twice, but move every base row for it.) A log known
    to hold each key once (``log_has_repeats=False``) is neither ranked nor
    made distinct.
    """
    touched = log.select(*keys)
    if log_has_repeats:
        touched = touched.distinct()
    kept = base.join(touched, list(keys), "left_anti").select(*base.columns)
    newest = latest_per_key(log, keys, order) if log_has_repeats else log
    if is_delete:
        newest = newest.where(~F.coalesce(F.col(is_delete), F.lit(False)))
    return kept.unionByName(newest.select(*base.columns))


def clean_limit(threshold: Column) -> Column:
    """Commits whose files cleaning keeps: twice the compaction threshold."""
    return threshold * 2


def archive_min(threshold: Column) -> Column:
    """Commits left after archiving: one more than cleaning keeps."""
    return clean_limit(threshold) + 1


def archive_max(threshold: Column) -> Column:
    """Archiving starts above this many commits."""
    return archive_min(threshold) + 20


def _timeline(commits: DataFrame, table: str, commit: str) -> DataFrame:
    """Distinct commits of each table, numbered from the newest, with the table's total.

    The distinct runs first, with map-side combine, so a table with a third of
    all versions contributes its commits here, not its versions.
    """
    of_table = Window.partitionBy(table)
    return (
        commits.select(table, commit).distinct()
        .withColumn("age_rank", F.row_number().over(of_table.orderBy(F.col(commit).desc())))
        .withColumn("total", F.count("*").over(of_table))
    )


def oldest_retained(commits: DataFrame, limits: DataFrame, table: str = "table_id", commit: str = "commit",
                    retained: str = "commits_retained") -> DataFrame:
    """The N-th newest commit of each table; tables with fewer commits are absent."""
    ranked = _timeline(commits, table, commit).join(limits, table)
    return ranked.where(F.col("age_rank") == F.col(retained)).select(table, F.col(commit).alias("oldest"))


def clean_plan(versions: DataFrame, oldest: DataFrame, table: str = "table_id", group: str = "file_group",
               commit: str = "commit") -> DataFrame:
    """File versions no retained commit reads.

    Readers of the oldest retained commit use the newest version of a file
    group at or before it; what is older goes. ``versions`` holds each (table,
    group, commit) once, ``oldest`` one row per table, and a table without a
    row there loses nothing.

    The join comes last: nothing after it needs its rows in one place, so a
    table with a third of all versions is split like any skewed join key. A
    file group has at most one version per commit, so the window's partitions
    are as small as a timeline.
    """
    successor = F.lead(commit).over(Window.partitionBy(table, group).orderBy(commit))
    followed = versions.withColumn("_next", successor).where(F.col("_next").isNotNull())
    return followed.join(oldest, table).where(F.col("_next") <= F.col("oldest")).select(table, group, commit)


def archive_plan(commits: DataFrame, limits: DataFrame, table: str = "table_id", commit: str = "commit",
                 keep_min: str = "keep_min", keep_max: str = "keep_max") -> DataFrame:
    """Commits to move out of the active timeline: all but the newest ``keep_min`` once over ``keep_max``."""
    ranked = _timeline(commits, table, commit).join(limits, table)
    return ranked.where((F.col("total") > F.col(keep_max)) & (F.col("age_rank") > F.col(keep_min))).select(
        table, commit)


def retention_plan(df: DataFrame, day: str, as_of: str, keep_days: int = 7) -> DataFrame:
    """Row count of every day and whether it is past retention (older than ``keep_days`` full days).

    A name that is no day is never past it.
    """
    oldest_kept = F.date_sub(F.lit(as_of).cast("date"), keep_days)
    return df.groupBy(day).agg(F.count("*").alias("rows")).withColumn(
        "expired", F.coalesce(F.col(day).try_cast("date") < oldest_kept, F.lit(False)))
