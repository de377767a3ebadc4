"""Per-key choices: latest row, first match, last lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank_in_key"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the highest ``order`` values (nulls lowest).

    ``row_number = 1`` is planned with a group limit before the one exchange:
    each map task ships at most one row per key, so a key that holds a third
    of all rows costs its reducer one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)


def last_per_group(df: DataFrame, group: Sequence[str], position: str, k: int) -> DataFrame:
    """The last ``k`` rows of each group by position, ranked 1 (last) to k; limited before the exchange."""
    w = Window.partitionBy(*group).orderBy(F.col(position).desc())
    return df.withColumn("from_end", F.row_number().over(w)).where(F.col("from_end") <= k)


def first_match(df: DataFrame, group: Sequence[str], match: Column, position: Sequence[str]) -> DataFrame:
    """The first non-empty ``match`` of each group in position order; NULL when nothing matches.

    An aggregate with map-side combine: one partial row per group and task is
    shuffled, whatever the group's size.
    """
    found = F.nullif(match, F.lit(""))
    at = F.when(found.isNotNull(), F.struct(*position))
    return df.groupBy(*group).agg(F.min_by(found, at).alias("match"))
