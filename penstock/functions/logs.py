"""Log-line columns: normalise, rate, compose, guard, inspect paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.functions.device import once

# Formats, patterns and ranks that results must equal.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
TIME_FORM = r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{1,3}\z"
LOG_FIELDS = ["app_name", "time_stamp", "level", "logger", "message", "thread", "exception"]
LAKE_COLUMNS = ["app_name", "time_stamp", "unix_time_stamp", "level", "logger", "message", "thread",
                "exception", "load_dt"]
LOG_FILE_PATTERN = r".*/([^/]+\.log)$"
UNSAFE_PATH_PATTERN = r"(\.\./|/\.\.|//|/\./)"
SEVERITY = {"DEBUG": 4, "INFO": 3, "WARN": 2, "ERROR": 1}
DEFAULT_SEVERITY = "INFO"
QUEUE_MESSAGE_LIMIT = 1000012
CHANNEL_MESSAGE_LIMIT = 2097152

LOG_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in LOG_FIELDS])

BAD_TIME = "unreadable time_stamp"
NO_APP = "missing app_name"
BAD_JSON = "invalid json"
UNREADABLE = "unreadable"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_key(time_stamp: Column | str, precision: str = "seconds") -> Column:
    """Epoch milliseconds of a log time, NULL when unreadable.

    The default keeps whole seconds (times 1000): lines of one app within a
    second share the key and collapse on upsert. ``precision="millis"`` keeps them.

    A cast behind a check of the exact form gives what parsing with
    ``TIME_FORMAT`` gives, at less than half the cost per row.
    """
    text = _col(time_stamp)
    ts = F.when(text.rlike(TIME_FORM), text.try_cast("timestamp"))
    if precision == "seconds":
        return F.unix_seconds(ts) * 1000
    if precision == "millis":
        return F.unix_millis(ts)
    raise ValueError(f"precision must be 'seconds' or 'millis', not {precision!r}")


def normalize_logs(logs: DataFrame, *keep: str, precision: str = "seconds") -> DataFrame:
    """The nine lake columns of raw log rows (spaces trimmed off the level only)."""
    derived = {
        "unix_time_stamp": once(epoch_key("time_stamp", precision)),
        "level": F.trim(F.col("level")),
        "load_dt": F.substring(F.col("time_stamp"), 1, 10),
    }
    return logs.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in LAKE_COLUMNS], *keep)


def has_key() -> Column:
    """Both record-key parts of a normalised row are present."""
    return F.col("app_name").isNotNull() & F.col("unix_time_stamp").isNotNull()


def reject_reason() -> Column:
    """Why a normalised row has no record key."""
    return F.when(F.col("app_name").isNull(), F.lit(NO_APP)).otherwise(F.lit(BAD_TIME))


def is_usable(normalized: DataFrame) -> Column:
    """The row has a record key, and its message was JSON where a column ``unreadable`` tells (``kafka.json_table``)."""
    return has_key() & F.col(UNREADABLE).isNull() if UNREADABLE in normalized.columns else has_key()


def log_rows(normalized: DataFrame) -> DataFrame:
    """Rows fit for the keyed table."""
    return normalized.where(is_usable(normalized))


def log_rejects(normalized: DataFrame) -> DataFrame:
    """The complement of :func:`log_rows`, with a reason."""
    reason = reject_reason()
    if UNREADABLE in normalized.columns:
        reason = F.when(F.col(UNREADABLE).isNotNull(), F.lit(BAD_JSON)).otherwise(reason)
    return normalized.where(~is_usable(normalized)).withColumn("reason", reason)


def log_file_name(path: Column | str) -> Column:
    """The ``*.log`` base name of a path, NULL when the path has none."""
    return F.nullif(F.regexp_extract(_col(path), LOG_FILE_PATTERN, 1), F.lit(""))


def severity_rank(level: Column | str) -> Column:
    """DEBUG 4 … ERROR 1; an unknown level ranks 0, so no limit hides it."""
    upper = F.upper(F.trim(_col(level)))
    ranks = F.when(F.lit(False), F.lit(0))
    for name, rank in SEVERITY.items():
        ranks = ranks.when(upper == name, F.lit(rank))
    return ranks.otherwise(F.lit(0))


def severity_allows(level: Column | str, limit: Column | str | None = None) -> Column:
    """True when a line of ``level`` passes the limit (a level name or a column; default INFO)."""
    if limit is None:
        limit = F.lit(DEFAULT_SEVERITY)
    elif isinstance(limit, str):
        limit = F.lit(limit)
    return severity_rank(level) <= severity_rank(F.coalesce(limit, F.lit(DEFAULT_SEVERITY)))


def compose_line(ts: Column, level: Column | str, message: Column | str) -> Column:
    """``<time> [LEVEL] <message>``; a missing message leaves the text after the tag empty."""
    text = ts if not isinstance(ts, str) else F.col(ts)
    return F.concat(text, F.lit(" ["), F.upper(F.trim(_col(level))), F.lit("] "),
                    F.coalesce(_col(message), F.lit("")))


def format_time(ts: Column | str) -> Column:
    """Timestamp text with milliseconds."""
    return F.date_format(_col(ts), TIME_FORMAT)


def fits_message(value: Column | str, limit: int = QUEUE_MESSAGE_LIMIT) -> Column:
    """The UTF-8 size of a message is within the limit (a null message has size 0)."""
    return F.coalesce(F.octet_length(_col(value)), F.lit(0)) <= F.lit(limit)


def is_unsafe_path(path: Column | str) -> Column:
    """A path with an upward, doubled or self step."""
    return _col(path).rlike(UNSAFE_PATH_PATTERN)


def is_below(path: Column | str, root: str) -> Column:
    """The path is the root or lies below it (``/a/bc`` is not below ``/a/b``)."""
    root = root.rstrip("/")
    return (_col(path) == root) | _col(path).startswith(root + "/")


def pad_key(key: Column | str, width: int = 30) -> Column:
    """Key padded with spaces to ``width``; longer keys stay whole."""
    key = _col(key)
    return F.rpad(key, F.greatest(F.lit(width), F.length(key)), F.lit(" "))


def key_value_line(key: Column | str, value: Column | str, indent: int = 0) -> Column:
    """``key   = value`` with the key padded; a null value prints ``null``."""
    return F.concat(F.lit("  " * indent), pad_key(key), F.lit(" = "),
                    F.coalesce(_col(value), F.lit("null")))
