"""Application logs: normalise, upsert, tail, archive, filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.functions import logs
from penstock.operators import counters, keyed, lake
from penstock.plans import fixtures
from penstock.plans.fixture_sql import LINES, LOGS, with_parts
from penstock.session import fresh_folder
from penstock.sources import folders, kafka, line_files, tail
from penstock.streaming import jobs

SIZE_LIMIT = 2000
AS_OF = "2024-01-31"
LOG_ROOT = "/logs/src1"
ERROR_LINES = 5
FILE_DOCUMENTS = 1000
UPSERT_KEY = ["load_dt", "app_name", "unix_time_stamp"]


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.app_logs(fixtures.table(spark, sf_dir, "events"))


def _normalized_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.app_log_messages(fixtures.table(spark, sf_dir, "events"))
    rows = kafka.json_table(messages, logs.LOG_SCHEMA, F.col("offset").alias("seq"))
    return logs.normalize_logs(rows, "seq")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.document_lines(fixtures.table(spark, sf_dir, "documents"))


def log_normalize(spark, sf_dir):
    return logs.log_rows(_normalized_messages(spark, sf_dir)).drop("seq")


def log_normalize_sql(spark, sf_dir):
    """The same as a statement over the declared message table."""
    messages = fixtures.app_log_messages(fixtures.table(spark, sf_dir, "events"))
    return spark.sql("""
        SELECT * FROM (
          SELECT app_name, time_stamp,
            unix_timestamp(try_to_timestamp(time_stamp, 'yyyy-MM-dd HH:mm:ss.SSS')) * 1000 AS unix_time_stamp,
            trim(level) AS level, logger, message, thread, exception, substring(time_stamp, 1, 10) AS load_dt
          FROM {messages})
        WHERE app_name IS NOT NULL AND unix_time_stamp IS NOT NULL""",
                     messages=kafka.json_table(messages, logs.LOG_SCHEMA))


def log_rejects(spark, sf_dir):
    return logs.log_rejects(_normalized_messages(spark, sf_dir)).select("seq", "app_name", "time_stamp", "reason")


def log_lake_upsert(spark, sf_dir):
    """The keyed table's content after all logs arrived."""
    rows = logs.log_rows(logs.normalize_logs(_logs(spark, sf_dir), "seq"))
    return keyed.latest_per_key(rows, UPSERT_KEY, ["seq"]).select(*logs.LAKE_COLUMNS)


def log_tail_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


def _written_lines(spark, sf_dir) -> str:
    """Documents as log files, one folder per source, many documents per file."""
    path = fresh_folder(spark, "logs")
    documents = fixtures.table(spark, sf_dir, "documents")
    lines = documents.select("source", "text").hint("rebalance", F.col("source"))
    lines.write.partitionBy("source").text(path)
    return folders.qualified(spark, path)


def _with_source(lines: DataFrame) -> DataFrame:
    return lines.select(F.regexp_extract("file", "source=([^/]+)/", 1).alias("source"), "value").groupBy(
        "source", "value").agg(F.count("*").alias("times"))


def log_tail_files(spark, sf_dir):
    """The tail source over real files: every line, counted per folder."""
    path = _written_lines(spark, sf_dir)
    return _with_source(tail.read(spark, path, pattern=r".*/source=[^/]+/part-.*\.txt"))


def log_closed_files(spark, sf_dir):
    """The same lines through the reader for closed files."""
    path = _written_lines(spark, sf_dir)
    return _with_source(line_files.read_lines(spark, path, glob="part-*.txt", pattern=".*/source=[^/]+/part-.*"))


def log_file_name(spark, sf_dir):
    files = _lines(spark, sf_dir).select(F.col("file").alias("path"), F.lit("file").alias("origin"))
    urls = fixtures.table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.lit("url").alias("origin"))
    return files.unionByName(urls).withColumn("logfile", logs.log_file_name("path"))


def _arrived_lines(spark, sf_dir) -> DataFrame:
    rows = _logs(spark, sf_dir)
    lines = rows.select(logs.compose_line("time_stamp", "level", "message").alias("value"), "arrival_ts")
    return jobs.with_day(lines, F.col("arrival_ts"))


def log_daily_archive(spark, sf_dir):
    """Lines written as gzip text per arrival day, then counted from the files."""
    path = fresh_folder(spark, "archive")
    jobs.archive_batch(_arrived_lines(spark, sf_dir), path)
    return jobs.read_archive(spark, path).groupBy("load_date").agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("value") + 1).alias("bytes"))


def message_size_guard(spark, sf_dir):
    """Every document with its size and whether a queue with a small limit takes it."""
    outcome = F.when(logs.fits_message("text", SIZE_LIMIT), F.lit("sent")).otherwise(F.lit("too long"))
    return fixtures.table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length("text").cast("long").alias("bytes"), outcome.alias("outcome"))


def log_severity(spark, sf_dir):
    """Composed lines that pass the default level limit."""
    rows = _logs(spark, sf_dir).where(logs.severity_allows("level"))
    return rows.select("seq", logs.compose_line(logs.format_time("arrival_ts"), "level", "message").alias("line"))


def error_tail(spark, sf_dir):
    return keyed.last_per_group(_lines(spark, sf_dir), ["file"], "line_no", ERROR_LINES)


def error_tail_files(spark, sf_dir):
    """The last lines of real log files, read from the files' ends; a thousand documents in a row are one file."""
    path = fresh_folder(spark, "log-ends")
    texts = fixtures.table(spark, sf_dir, "documents").where("text IS NOT NULL").select(
        F.floor(F.col("doc_id") / FILE_DOCUMENTS).alias("part"), "doc_id", "text")
    texts.repartition("part").sortWithinPartitions("part", "doc_id").select("part", "text").write.partitionBy(
        "part").text(path)
    lines = tail.read(spark, path, pattern=r".*/part=[^/]+/part-.*\.txt", lastLines=ERROR_LINES)
    return keyed.last_per_group(lines, ["file"], "position", ERROR_LINES).select(
        F.regexp_extract("file", "part=([^/]+)/", 1).cast("long").alias("part"), "value", "from_end")


def retention_plan(spark, sf_dir):
    days = _logs(spark, sf_dir).select(F.date_format("arrival_ts", "yyyy-MM-dd").alias("load_date"))
    return lake.retention_plan(days, "load_date", AS_OF)


def path_safety(spark, sf_dir):
    """Paths of pages and log files, some with unsafe steps, rated."""
    url_path = F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1)
    pages = fixtures.table(spark, sf_dir, "pages").select(url_path.alias("path"))
    n = F.col("doc_id")
    step = F.when(n % 5 == 0, "/../").when(n % 5 == 1, "//").when(n % 5 == 2, "/./").otherwise("/")
    files = fixtures.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/logs/"), "source", step, n.cast("string"), F.lit(".log")).alias("path"))
    return pages.unionByName(files).select(
        "path", logs.is_unsafe_path("path").alias("unsafe"), logs.is_below("path", LOG_ROOT).alias("below_root"))


def batch_counts(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 1000).alias("batch_id"), (F.col("event_id") + 1).alias("n"))
    return counters.count_by(events, "batch_id", marks_of="n")


QUERIES = {f.__name__: f for f in [
    log_normalize, log_normalize_sql, log_rejects, log_lake_upsert, log_tail_lines, log_tail_files, log_closed_files, log_file_name,
    log_daily_archive, message_size_guard, log_severity, error_tail, error_tail_files, retention_plan, path_safety, batch_counts,
]}

_LAKE = "app_name, time_stamp, unix_time_stamp, level, logger, message, thread, exception, load_dt"
LAKE_UPSERT_SQL = with_parts(f"""
SELECT {_LAKE} FROM (
  SELECT *, row_number() OVER (PARTITION BY app_name, unix_time_stamp ORDER BY seq DESC) AS rn FROM normal WHERE good)
WHERE rn = 1""", LOGS)
MESSAGE_LAKE_SQL = with_parts(f"""
SELECT {_LAKE} FROM (
  SELECT *, row_number() OVER (PARTITION BY app_name, unix_time_stamp ORDER BY arrival_ts DESC, seq % 4 DESC, seq DESC)
    AS rn
  FROM normal WHERE good AND seq % 41 <> 0 AND seq % 43 <> 0)
WHERE rn = 1""", LOGS)
MESSAGE_REJECTS_SQL = with_parts("""
SELECT CAST(seq % 4 AS INTEGER) AS "partition", seq AS "offset",
  CASE WHEN seq % 41 <> 0 AND seq % 43 <> 0 THEN app_name END AS app_name,
  CASE WHEN seq % 41 <> 0 THEN time_stamp END AS time_stamp, seq % 41 = 0 AS has_text,
  CASE WHEN seq % 41 = 0 THEN 'invalid json' WHEN seq % 43 = 0 THEN 'missing app_name'
    ELSE 'unreadable time_stamp' END AS reason
FROM normal WHERE seq % 41 = 0 OR seq % 43 = 0 OR NOT good""", LOGS)
SOURCE_LINES_SQL = with_parts(
    "SELECT source, value, count(*) AS times FROM lines GROUP BY source, value", LINES)
ARCHIVE_SQL = with_parts("""
SELECT strftime(arrival_ts, '%Y-%m-%d') AS load_date, count(*) AS lines,
  CAST(sum(octet_length(encode(time_stamp || ' [' || level || '] ' || message)) + 1) AS BIGINT) AS bytes
FROM normal GROUP BY 1""", LOGS)

NORMALIZE_SQL = with_parts(f"SELECT {_LAKE} FROM normal WHERE good", LOGS)

ORACLE = {
    "log_normalize": NORMALIZE_SQL,
    "log_normalize_sql": NORMALIZE_SQL,
    "log_rejects": with_parts("""
SELECT seq, app_name, time_stamp, 'unreadable time_stamp' AS reason FROM normal
WHERE try_strptime(time_stamp, '%Y-%m-%d %H:%M:%S.%g') IS NULL""", LOGS),
    "log_lake_upsert": LAKE_UPSERT_SQL,
    "log_tail_lines": with_parts("SELECT file, line_no, value FROM lines", LINES),
    "log_tail_files": SOURCE_LINES_SQL,
    "log_closed_files": SOURCE_LINES_SQL,
    "log_file_name": with_parts("""
SELECT file AS path, 'file' AS origin, CAST(doc_id AS VARCHAR) || '.log' AS logfile FROM lines
UNION ALL
SELECT url, 'url', nullif(regexp_extract(url, '.*/([^/]+\\.log)$', 1), '') FROM pages""", LINES),
    "log_daily_archive": ARCHIVE_SQL,
    "message_size_guard": f"""
SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS bytes,
  CASE WHEN octet_length(encode(text)) <= {SIZE_LIMIT} THEN 'sent' ELSE 'too long' END AS outcome
FROM documents""",
    "log_severity": with_parts("""
SELECT seq, strftime(arrival_ts, '%Y-%m-%d %H:%M:%S.') || lpad(CAST((epoch_us(arrival_ts) // 1000) % 1000 AS VARCHAR), 3, '0')
  || ' [' || level || '] ' || message AS line
FROM normal WHERE rank <= 3""", LOGS),
    "error_tail": with_parts("""
SELECT file, line_no, value, from_end FROM (
  SELECT *, CAST(max(line_no) OVER (PARTITION BY file) - line_no + 1 AS INTEGER) AS from_end FROM lines) WHERE from_end <= 5""", LINES),
    "error_tail_files": with_parts(f"""
SELECT part, value, from_end FROM (
  SELECT doc_id // {FILE_DOCUMENTS} AS part, value, CAST(row_number() OVER (
    PARTITION BY doc_id // {FILE_DOCUMENTS} ORDER BY doc_id DESC, line_no DESC) AS INTEGER) AS from_end
  FROM lines) WHERE from_end <= {ERROR_LINES}""", LINES),
    "retention_plan": f"""
SELECT strftime(ts, '%Y-%m-%d') AS load_date, count(*) AS rows,
  date_diff('day', CAST(min(ts) AS DATE), DATE '{AS_OF}') > 7 AS expired
FROM events GROUP BY 1""",
    "path_safety": f"""
SELECT path, contains(path, '../') OR contains(path, '/..') OR contains(path, '//') OR contains(path, '/./') AS unsafe,
  path = '{LOG_ROOT}' OR starts_with(path, '{LOG_ROOT}/') AS below_root
FROM (
  SELECT regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS path FROM pages
  UNION ALL
  SELECT '/logs/' || source || CASE doc_id % 5 WHEN 0 THEN '/../' WHEN 1 THEN '//' WHEN 2 THEN '/./' ELSE '/' END
    || CAST(doc_id AS VARCHAR) || '.log' FROM documents)""",
    "batch_counts": """
SELECT event_id // 1000 AS batch_id, count(*) AS rows, count(*) FILTER ((event_id + 1) % 10 = 0) AS marks
FROM events GROUP BY 1""",
}
