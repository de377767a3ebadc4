"""The fixtures of :mod:`penstock.plans.fixtures` as SQL over the raw tables, for the DuckDB comparison.

Stated independently of the Spark expressions: which records are bad follows
from key arithmetic, and no text that Spark has to parse is parsed here.
"""

DEVICE = """
device AS (
  SELECT event_id, CAST(event_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
    epoch_us(ts) // 1000 AS ms,
    'device-' || CAST(user_id + 10000 AS VARCHAR) AS id,
    CASE event_id % 4 WHEN 0 THEN 'online' WHEN 1 THEN 'offline' WHEN 2 THEN 'warning' ELSE 'error' END AS status,
    CAST(event_id % 15 + 20 AS VARCHAR) AS temperature,
    CAST(value AS VARCHAR) AS voltage,
    CASE WHEN event_id % 23 = 0 THEN 'cut' WHEN event_id % 29 = 0 THEN 'bare'
         WHEN event_id % 31 = 0 THEN 'list' ELSE 'good' END AS kind
  FROM events),
message AS (
  SELECT *, CASE kind
      WHEN 'bare' THEN head || '}'
      WHEN 'list' THEN head || ',"payload":[1]}'
      WHEN 'cut' THEN left(whole, length(whole) - 1)
      ELSE whole END AS value
  FROM (SELECT *, head || ',"payload":{"id":"' || id || '","status":"' || status || '","temperature":'
               || temperature || ',"voltage":' || voltage || '}}' AS whole
        FROM (SELECT *, '{"event":"device_status","timestamp":' || CAST(ms AS VARCHAR) AS head FROM device)))
"""

LOGS = """
logs AS (
  SELECT event_id AS seq, 'app-' || CAST(user_id % 5 AS VARCHAR) AS app_name,
    event_id % 37 <> 0 AS good,
    TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 250 MILLISECOND * event_id AS written,
    1704067200 + event_id // 4 AS second,
    CASE event_id % 4 WHEN 0 THEN 'DEBUG' WHEN 1 THEN 'INFO' WHEN 2 THEN 'WARN' ELSE 'ERROR' END AS level,
    4 - event_id % 4 AS rank,
    event_type AS logger, props AS message, 't-' || CAST(event_id % 8 AS VARCHAR) AS thread,
    CASE WHEN event_type = 'error' THEN 'E' || CAST(user_id AS VARCHAR) END AS exception,
    ts AS arrival_ts
  FROM events),
normal AS (
  SELECT seq, app_name, CASE WHEN good THEN strftime(written, '%Y-%m-%d %H:%M:%S.%g') ELSE 'bad' END AS time_stamp,
    CASE WHEN good THEN second * 1000 END AS unix_time_stamp, level, logger, message, thread, exception,
    CASE WHEN good THEN strftime(written, '%Y-%m-%d') ELSE 'bad' END AS load_dt,
    good, rank, arrival_ts
  FROM logs)
"""

CONFIG = """
config AS (
  SELECT p_partkey AS k,
    CASE WHEN p_partkey % 13 = 0 THEN 'nodot' || CAST(p_partkey AS VARCHAR)
         ELSE 'db' || CAST(p_partkey % 7 AS VARCHAR) || '.' || tbl END AS full_table_name,
    CASE WHEN p_partkey % 13 <> 0 THEN 'db' || CAST(p_partkey % 7 AS VARCHAR) END AS schema_name,
    CASE WHEN p_partkey % 13 <> 0 THEN tbl END AS table_name,
    CAST(CASE WHEN p_partkey % 17 <> 0 THEN p_size % 10 + 1 END AS INTEGER) AS compaction_commit_threshold,
    CAST(p_size % 4 + 1 AS INTEGER) AS spark_executor_cores,
    CAST(p_size % 8 + 1 AS VARCHAR) || 'g' AS spark_executor_memory,
    '1g' AS spark_driver_memory,
    CAST(p_size + 5 AS INTEGER) AS spark_shuffle_partitions,
    CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END AS spark_dynamic_allocation,
    CAST(CASE WHEN p_partkey % 19 <> 0 THEN 1 END AS INTEGER) AS spark_dynamic_min_executors,
    CAST(p_size % 10 + 2 AS INTEGER) AS spark_dynamic_max_executors,
    CAST(CASE WHEN p_partkey % 23 <> 0 THEN p_size % 3 + 1 END AS INTEGER) AS spark_dynamic_initial_executors,
    CAST(p_size % 24 AS VARCHAR) AS schedule_hours, 'UTC' AS schedule_timezone,
    CAST(p_partkey % 5 AS INTEGER) AS priority_level, 'true' AS enable_monitoring, 'false' AS alert_on_failure,
    CAST(NULL AS VARCHAR) AS alert_recipients, CAST(p_size % 4 AS INTEGER) AS max_retry_times,
    p_name AS remark, '2024-01-01' AS load_dt, p_type <> 'PROMO' AS is_active, p_brand
  FROM (SELECT *, 'tbl_' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 11 = 0 THEN '.x' ELSE '' END AS tbl
        FROM part)),
active AS (SELECT * FROM config WHERE is_active),
runnable AS (SELECT * FROM active WHERE schema_name IS NOT NULL AND compaction_commit_threshold IS NOT NULL),
outcome AS (
  SELECT p_partkey AS k, run, p_partkey % 7 AS db,
    CASE WHEN (p_partkey + run) % 10 = 9 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN (p_partkey + run) % 10 <> 9 THEN 'application_' || CAST(1700000000000 + p_partkey AS VARCHAR) || '_'
      || lpad(CAST(run + p_partkey % 1000 AS VARCHAR), 4, '0') END AS application_id
  FROM part, (SELECT 1 AS run UNION ALL SELECT 2) r WHERE run = 1 OR p_partkey % 3 = 0)
"""

VERSIONS = """
versions AS (
  SELECT DISTINCT l_suppkey AS table_id, l_partkey % 20 AS file_group,
    year(l_shipdate) * 100 + month(l_shipdate) AS "commit"
  FROM lineitem),
limits AS (SELECT s_suppkey AS table_id, s_suppkey % 40 + 1 AS t FROM supplier),
commits AS (SELECT DISTINCT table_id, "commit" FROM versions)
"""

SETTINGS = """
defaults AS (
  SELECT 'c' || CAST(s_nationkey AS VARCHAR) AS cluster,
    CASE s_suppkey % 3 WHEN 0 THEN 'server' WHEN 1 THEN 'producer' ELSE 'consumer' END AS role,
    'k' || CAST(s_suppkey % 10 AS VARCHAR) AS key, CAST(max(s_suppkey) AS VARCHAR) AS value
  FROM supplier GROUP BY 1, 2, 3),
overrides AS (
  SELECT 'c' || CAST(c_nationkey AS VARCHAR) AS cluster, 't' || CAST(c_custkey // 100 AS VARCHAR) AS topic,
    CASE c_custkey % 2 WHEN 0 THEN 'producer' ELSE 'consumer' END AS role,
    'k' || CAST(c_custkey % 13 AS VARCHAR) AS key, CAST(max(c_custkey) AS VARCHAR) AS value
  FROM customer GROUP BY 1, 2, 3, 4),
configured AS (SELECT DISTINCT cluster, topic FROM overrides)
"""

LINES = """
lines AS (
  SELECT '/logs/' || source || '/' || CAST(doc_id AS VARCHAR) || '.log' AS file,
    doc_id, source, line_no, parts[line_no] AS value
  FROM (SELECT doc_id, source, parts, unnest(range(1, len(parts) + 1)) AS line_no
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents)))
"""


def with_parts(select: str, *parts: str) -> str:
    """A statement over the given fixture parts."""
    return "WITH " + ",".join(p.strip() for p in parts) + "\n" + select.strip()
