"""Bounded synthetic device events, as a batch or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.functions import device

# The ranges generated fields fall into.
FIRST_DEVICE = 10000
TEMPERATURE_MIN, TEMPERATURE_STEPS = 20, 15
VOLTAGE_MIN, VOLTAGE_SPAN = 3.5, 1.5
DEFAULT_RECORDS = 100
DEFAULT_INTERVAL_MS = 500


def device_fields(n: Column, at: Column, seed: int) -> list[Column]:
    """The fields of the ``n``-th record (zero-based); random ones depend on the seed."""
    return [
        n.alias("n"),
        F.lit("device_status").alias("event"),
        F.unix_millis(at).alias("timestamp"),
        F.concat(F.lit("device-"), (n + FIRST_DEVICE).cast("string")).alias("id"),
        device.pick_state(F.floor(F.rand(seed) * len(device.DEVICE_STATES))).alias("status"),
        (F.floor(F.rand(seed + 1) * TEMPERATURE_STEPS) + TEMPERATURE_MIN).alias("temperature"),
        (F.rand(seed + 2) * VOLTAGE_SPAN + VOLTAGE_MIN).alias("voltage"),
    ]


def as_message(fields: DataFrame) -> DataFrame:
    """The running number and JSON text of generated fields."""
    return fields.select("n", device.event_json(
        F.col("event"), F.col("timestamp"), id=F.col("id"), status=F.col("status"),
        temperature=F.col("temperature"), voltage=F.col("voltage")).alias("value"))


def generate(spark: SparkSession, records: int = DEFAULT_RECORDS, seed: int = 0,
             at: Column | None = None) -> DataFrame:
    """``records`` device events; partitions generate their own ranges."""
    now = F.current_timestamp() if at is None else at
    return spark.range(records).select(*device_fields(F.col("id"), now, seed))


def generate_stream(spark: SparkSession, records: int = DEFAULT_RECORDS, seed: int = 0,
                    rows_per_batch: int = 10, interval_ms: int = DEFAULT_INTERVAL_MS,
                    tasks: int | None = None) -> DataFrame:
    """The same as a stream that adds ``rows_per_batch`` records each interval and dries up after ``records``.

    The numbers of a batch are dealt over ``tasks`` tasks (by default one per core), so a batch's records come in no
    particular order; ``n`` has it.
    """
    ticks = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("numPartitions", tasks or spark.sparkContext.defaultParallelism)
        .option("advanceMillisPerBatch", interval_ms)
        .load()
    )
    return ticks.where(F.col("value") < records).select(*device_fields(F.col("value"), F.col("timestamp"), seed))
