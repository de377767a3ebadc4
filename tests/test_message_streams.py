"""JSON messages into the keyed table in one job, and streams without repeats."""

from __future__ import annotations

import os
import random

import numpy as np
from penstock.functions import logs
from penstock.session import conf
from penstock.sources import kafka, seen_offsets
from penstock.streaming import jobs

RECORD = "value string, topic string, partition int, offset long, timestamp timestamp"


def message(app, second, text, level=" INFO "):
    return (f'{{"app_name":{app},"time_stamp":"2024-01-01 00:00:{second:02d}.000","level":"{level}",'
            f'"message":"{text}"}}')


def place(spark, folder, name, rows):
    """Records as one more file of a folder, visible as a whole."""
    spark.createDataFrame([(v, "logs", p, o, None) for v, p, o in rows], RECORD).coalesce(1).write.parquet(
        f"{folder}/{name}")


def upserted(spark, folder, name, batches):
    table = jobs.message_table(spark, f"{folder}/{name}/table")
    for i, rows in enumerate(batches):
        place(spark, f"{folder}/{name}/in", f"part={i}", rows)
        records = spark.readStream.schema(RECORD).parquet(f"{folder}/{name}/in")
        jobs.upsert_messages(records, table, f"{folder}/{name}/rejects", f"{folder}/{name}/checkpoint",
                             once=True).awaitTermination()
    rejects = jobs.read_message_rejects(spark, f"{folder}/{name}/rejects").select(
        "arrival.partition", "arrival.offset", "app_name", logs.UNREADABLE, "reason")
    return (sorted((r["app_name"], r["message"], r["level"]) for r in table.snapshot().collect()),
            sorted(map(tuple, rejects.collect()), key=str))


def test_every_message_ends_in_one_place(spark, folder):
    cut = message('"a"', 3, "cut")[:-1]
    first = [(message('"a"', 1, "old"), 0, 1), (cut, 0, 2), (message("null", 1, "no app"), 1, 1), (None, 1, 2), ("[1]", 1, 3)]
    second = [(message('"a"', 1, "new"), 0, 3), (message('"b"', 1, "other"), 1, 4),
              ('{"app_name":"c","time_stamp":"bad"}', 1, 5)]
    rows, rejects = upserted(spark, folder, "two", [first, second])
    assert rows == [("a", "new", "INFO"), ("b", "other", "INFO")]
    assert rejects == sorted([
        (0, 2, None, cut, logs.BAD_JSON), (1, 1, None, None, logs.NO_APP), (1, 2, None, None, logs.NO_APP),
        (1, 3, None, "[1]", logs.BAD_JSON), (1, 5, "c", None, logs.BAD_TIME)], key=str)
    assert upserted(spark, folder, "one", [first + second]) == (rows, rejects)


def test_a_repeated_batch_gives_the_same_rows(spark, folder):
    rows = [(message('"a"', i % 7, f"m{i}"), i % 2, i) for i in range(40)] + [("{", 0, 99)]
    want = upserted(spark, folder, "x", [rows])
    commits = f"{folder}/x/checkpoint/commits"
    for name in os.listdir(commits):
        if name.startswith(("0", ".0")):
            os.remove(f"{commits}/{name}")
    records = spark.readStream.schema(RECORD).parquet(f"{folder}/x/in")
    table = jobs.message_table(spark, f"{folder}/x/table")
    jobs.upsert_messages(records, table, f"{folder}/x/rejects", f"{folder}/x/checkpoint", once=True).awaitTermination()
    again = sorted((r["app_name"], r["message"], r["level"]) for r in table.snapshot().collect())
    assert again == want[0] and len(again) == 7
    assert jobs.read_message_rejects(spark, f"{folder}/x/rejects").count() == 1


def first_records(spark, folder):
    records = spark.readStream.schema(RECORD).parquet(f"{folder}/in")
    with conf(spark, kafka.STATE_STORE):
        jobs.write_lines(kafka.first_of_each(records), f"{folder}/out", f"{folder}/checkpoint", once=True)
    return sorted((r["partition"] if r["partition"] is not None else -1, r["offset"], r["value"])
                  for r in spark.read.schema(RECORD).parquet(f"{folder}/out").collect())


def test_repeats_vanish_over_batches_and_restarts(spark, folder):
    place(spark, f"{folder}/in", "part=0", [("a", 0, 0), ("a", 0, 0), ("b", 0, 5), ("c", 1, 0)])
    assert first_records(spark, folder) == [(0, 0, "a"), (0, 5, "b"), (1, 0, "c")]
    place(spark, f"{folder}/in", "part=1", [("a", 0, 0), ("d", 0, 3), ("b", 0, 5), ("c", 1, 0), ("e", 1, 1),
                                            ("no place", None, 7), ("no place", None, 7)])
    assert first_records(spark, folder) == [
        (-1, 7, "no place"), (-1, 7, "no place"), (0, 0, "a"), (0, 3, "d"), (0, 5, "b"), (1, 0, "c"), (1, 1, "e")]


def test_ranges_hold_the_gaps_only():
    draw = random.Random(1)
    offsets, seen = list(range(500)), set()
    draw.shuffle(offsets)
    starts = ends = np.zeros(0, np.int64)
    while offsets:
        batch = sorted({*(offsets.pop() for _ in range(min(20, len(offsets)))), *draw.sample(range(500), 5)})
        starts, ends, new = seen_offsets.merged_ranges(starts, ends, np.array(batch))
        assert [o for o, n in zip(batch, new) if n] == [o for o in batch if o not in seen]
        seen |= set(batch)
        assert [x for a, b in zip(starts, ends) for x in range(a, b + 1)] == sorted(seen)
        assert all(starts[1:] > ends[:-1] + 1)
    assert len(starts) == 1
    unchanged = seen_offsets.merged_ranges(starts, ends, np.zeros(0, np.int64))
    assert len(unchanged[0]) == 1 and not len(unchanged[2])
