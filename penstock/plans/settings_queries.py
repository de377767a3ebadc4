"""Layered settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.operators import settings
from penstock.plans import fixtures
from penstock.plans.fixture_sql import SETTINGS, with_parts

# A layer a program sets over everything configured: some keys of one role, others of the other.
CODE = {"producer": {"k1": "code", "k99": "code"}, "consumer": {"k2": "code-read"}}


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (fixtures.settings_defaults(fixtures.table(spark, sf_dir, "supplier")),
            fixtures.settings_overrides(fixtures.table(spark, sf_dir, "customer")))


def _topics(defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """All configured topics and, for every cluster, one that is not."""
    missing = defaults.select("cluster", F.lit("t-none").alias("topic"))
    return overrides.select("cluster", "topic").union(missing)


def settings_effective(spark, sf_dir):
    defaults, overrides = _tables(spark, sf_dir)
    return settings.effective(_topics(defaults, overrides), defaults, overrides)


def settings_topic(spark, sf_dir):
    """What a topic's own configuration holds after inheriting the role defaults."""
    defaults, overrides = _tables(spark, sf_dir)
    return settings.effective(overrides, defaults, overrides, with_server=False)


def settings_in_code(spark, sf_dir):
    defaults, overrides = _tables(spark, sf_dir)
    return settings.effective(_topics(defaults, overrides), defaults, overrides, code=CODE)


def settings_invalid_keys(spark, sf_dir):
    defaults, overrides = _tables(spark, sf_dir)
    return settings.invalid_keys(defaults.unionByName(overrides), fixtures.allowed_keys(spark))


def settings_lookup(spark, sf_dir):
    defaults, overrides = _tables(spark, sf_dir)
    requests = fixtures.settings_requests(fixtures.table(spark, sf_dir, "orders"))
    return settings.lookup(requests, defaults, overrides)


def settings_listing(spark, sf_dir):
    defaults, overrides = _tables(spark, sf_dir)
    return settings.listing(defaults, overrides)


def settings_sections(spark, sf_dir):
    """Each topic's client configurations as maps, shown as JSON."""
    defaults, overrides = _tables(spark, sf_dir)
    merged = settings.effective(overrides, defaults, overrides)
    maps = settings.sections(merged, fixtures.allowed_keys(spark))
    return maps.select("cluster", "topic", "role", F.to_json("entries").alias("entries"))


QUERIES = {f.__name__: f for f in [
    settings_effective, settings_topic, settings_in_code, settings_invalid_keys, settings_lookup, settings_listing,
    settings_sections,
]}

# Effective settings by one lookup per layer: every (topic, role, key) any layer names, first layer that has it.
_RESOLVED = """
roles AS (SELECT 'producer' AS client UNION ALL SELECT 'consumer'),
keys AS (
  SELECT t.cluster, t.topic, r.client, d.key FROM topics t, roles r, defaults d
  WHERE d.cluster = t.cluster AND (d.role = r.client OR (d.role = 'server' AND use_server))
  UNION SELECT o.cluster, o.topic, o.role, o.key FROM overrides o JOIN topics t USING (cluster, topic)),
resolved AS (
  SELECT k.cluster, k.topic, k.client AS role, k.key, o.value AS own, d.value AS role_default, s.value AS server
  FROM keys k
  LEFT JOIN overrides o ON o.cluster = k.cluster AND o.topic = k.topic AND o.role = k.client AND o.key = k.key
  LEFT JOIN defaults d ON d.cluster = k.cluster AND d.role = k.client AND d.key = k.key
  LEFT JOIN defaults s ON s.cluster = k.cluster AND s.role = 'server' AND s.key = k.key),
effective AS (
  SELECT cluster, topic, role, key, coalesce(own, role_default, server) AS value,
    CASE WHEN own IS NOT NULL THEN 'topic' WHEN role_default IS NOT NULL THEN 'cluster' ELSE 'server' END AS layer
  FROM resolved)
"""


def _resolved(topics: str, use_server: bool) -> list[str]:
    return [SETTINGS, f"topics AS (SELECT *, {str(use_server).lower()} AS use_server FROM ({topics}))", _RESOLVED]


_EFFECTIVE = "SELECT cluster, topic, role, key, value, layer FROM effective"
_CONFIGURED = "SELECT cluster, topic FROM configured"

ORACLE = {
    "settings_effective": with_parts(_EFFECTIVE, *_resolved(
        _CONFIGURED + " UNION SELECT cluster, 't-none' FROM defaults", True)),
    "settings_topic": with_parts(_EFFECTIVE, *_resolved(_CONFIGURED, False)),
    "settings_in_code": with_parts("""
SELECT e.* FROM effective e LEFT JOIN code c ON e.role = c.role AND e.key = c.key WHERE c.key IS NULL
UNION ALL SELECT DISTINCT t.cluster, t.topic, c.role, c.key, c.value, 'code' FROM topics t, code c""",
                                   *_resolved(_CONFIGURED + " UNION SELECT cluster, 't-none' FROM defaults", True), """
code AS (SELECT 'producer' AS role, 'k1' AS key, 'code' AS value UNION ALL SELECT 'producer', 'k99', 'code'
  UNION ALL SELECT 'consumer', 'k2', 'code-read')"""),
    "settings_invalid_keys": with_parts("""
SELECT cluster, topic, role, key, value FROM (
  SELECT cluster, NULL AS topic, role, key, value FROM defaults UNION ALL
  SELECT cluster, topic, role, key, value FROM overrides) s
WHERE role <> 'server' AND NOT EXISTS (SELECT 1 FROM range(12) w(i) WHERE s.key = 'k' || CAST(i AS VARCHAR))""",
                                        SETTINGS),
    "settings_lookup": with_parts("""
SELECT o_orderkey AS request_id, r.cluster, r.topic,
  r.cluster IN (SELECT cluster FROM defaults UNION SELECT cluster FROM overrides) AS cluster_found,
  t.own_settings IS NOT NULL AS topic_found, coalesce(t.own_settings, 0) AS own_settings
FROM (SELECT o_orderkey, 'c' || CAST(o_orderkey % 30 AS VARCHAR) AS cluster,
        't' || CAST(o_custkey // 100 AS VARCHAR) AS topic FROM orders) r
LEFT JOIN (SELECT cluster, topic, count(*) AS own_settings FROM overrides GROUP BY 1, 2) t USING (cluster, topic)""",
                                  SETTINGS),
    "settings_sections": with_parts("""
SELECT cluster, topic, role, '{' || string_agg('"' || key || '":"' || value || '"', ',' ORDER BY key) || '}' AS entries
FROM effective WHERE key IN (SELECT 'k' || CAST(i AS VARCHAR) FROM range(12) w(i)) GROUP BY cluster, topic, role""",
                                    *_resolved(_CONFIGURED, True)),
    "settings_listing": with_parts("""
SELECT cluster, CAST(NULL AS VARCHAR) AS topic, key,
  CASE role WHEN 'server' THEN 'SERVER CONFIGURATION' WHEN 'producer' THEN 'SERVER PRODUCER CONFIGURATION'
    ELSE 'SERVER CONSUMER CONFIGURATION' END AS group_name,
  key || repeat(' ', 30 - length(key)) || ' = ' || value AS line
FROM defaults
UNION ALL
SELECT cluster, topic, key, CASE role WHEN 'producer' THEN 'PRODUCER SETTINGS' ELSE 'CONSUMER SETTINGS' END,
  '  ' || key || repeat(' ', 30 - length(key)) || ' = ' || value
FROM effective""", *_resolved(_CONFIGURED, False)),
}
