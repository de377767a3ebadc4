"""Lake-table upkeep as relational plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from penstock.operators import lake, maintenance
from penstock.plans import fixtures
from penstock.plans.fixture_sql import VERSIONS, with_parts


def lake_compact(spark, sf_dir):
    """Base and log folded: the newest log row per key, deleted keys gone."""
    base = fixtures.lake_base(fixtures.table(spark, sf_dir, "customer"))
    log = fixtures.lake_log(fixtures.table(spark, sf_dir, "orders"))
    return lake.merge_on_read(base, log, ["record_key"], ["commit", "seq"], "is_delete")


def _versions_and_limits(spark, sf_dir):
    versions = fixtures.file_versions(fixtures.table(spark, sf_dir, "lineitem"))
    thresholds = fixtures.table_thresholds(fixtures.table(spark, sf_dir, "supplier"))
    return versions, maintenance.with_upkeep_limits(thresholds)


def lake_clean_plan(spark, sf_dir):
    versions, limits = _versions_and_limits(spark, sf_dir)
    oldest = lake.oldest_retained(versions, limits.select("table_id", "commits_retained"))
    return lake.clean_plan(versions, oldest)


def lake_archive_plan(spark, sf_dir):
    versions, limits = _versions_and_limits(spark, sf_dir)
    return lake.archive_plan(versions, limits.select("table_id", "keep_min", "keep_max"))


QUERIES = {f.__name__: f for f in [lake_compact, lake_clean_plan, lake_archive_plan]}

ORACLE = {
    "lake_compact": """
WITH log AS (
  SELECT o_custkey AS record_key, o_totalprice AS amount, strftime(o_orderdate, '%Y-%m-%d') AS "commit",
    o_orderkey AS seq, o_orderkey % 19 = 0 AS is_delete,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders),
last AS (SELECT * FROM log WHERE rn = 1)
SELECT coalesce(l.record_key, c_custkey) AS record_key,
  CASE WHEN l.record_key IS NULL THEN c_acctbal ELSE l.amount END AS amount, l."commit" AS "commit",
  coalesce(l.seq, -1) AS seq
FROM customer FULL OUTER JOIN last l ON l.record_key = c_custkey
WHERE l.is_delete IS NOT TRUE""",
    "lake_clean_plan": with_parts("""
SELECT v.table_id, v.file_group, v."commit" FROM versions v
JOIN limits USING (table_id)
WHERE EXISTS (
  SELECT 1 FROM versions n WHERE n.table_id = v.table_id AND n.file_group = v.file_group AND n."commit" > v."commit"
  AND (SELECT count(*) FROM commits c WHERE c.table_id = v.table_id AND c."commit" >= n."commit") >= 2 * t)""",
                                  VERSIONS),
    "lake_archive_plan": with_parts("""
SELECT c.table_id, c."commit" FROM commits c JOIN limits USING (table_id)
WHERE (SELECT count(*) FROM commits a WHERE a.table_id = c.table_id) > 2 * t + 21
  AND (SELECT count(*) FROM commits b WHERE b.table_id = c.table_id AND b."commit" > c."commit") >= 2 * t + 1""",
                                    VERSIONS),
}
