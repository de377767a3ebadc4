"""Streams without repeats at scale: batches, the state's size, places of records."""

from __future__ import annotations

import glob
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from penstock.plans import stream_queries
from penstock.session import conf, shared_root
from penstock.sources import kafka, seen_offsets
from penstock.streaming import jobs


class Value:
    def __init__(self):
        self.held, self.written = None, 0

    def get(self):
        return self.held

    def update(self, row):
        self.held = row
        self.written += 16 * len(row[0])


class Map:
    def __init__(self):
        self.held, self.written = {}, 0

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, row):
        self.held[key] = row
        self.written += len(row[0])

    def removeKey(self, key):
        del self.held[key]


class Handle:
    """The state of one key of a running query."""

    def __init__(self):
        self.states = {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    def getMapState(self, name, *schema):
        return self.states.setdefault(name, Map())


def passed(handle, batch, frame=1000):
    """The offsets that one batch lets through."""
    processor = seen_offsets.SeenOffsets("offset", ["offset"], 1)
    processor.init(handle)
    frames = (pd.DataFrame({"offset": batch[i:i + frame], "_share": 0}) for i in range(0, len(batch), frame))
    out = pd.concat(processor.handleInputRows(("t", 0, 0), frames, None))
    assert list(out.columns) == ["offset"]
    return out["offset"].tolist()


def test_a_batch_writes_what_lies_around_its_offsets():
    handle, written = Handle(), []
    for i in range(30):
        before = sum(s.written for s in handle.states.values())
        batch = list(range(i * 100_000, (i + 1) * 100_000, 4))  # every offset has a gap beside it
        assert passed(handle, batch + batch[:100], 30_000) == batch
        assert passed(handle, batch[::50]) == []
        written.append(sum(s.written for s in handle.states.values()) - before)
    assert max(written[10:]) < 2 * max(written[:10])


def test_full_blocks_are_one_range():
    handle = Handle()
    assert passed(handle, list(range(200_000)), 10_000) == list(range(200_000))
    assert handle.states["full"].held == ([0], [2]) and list(handle.states["open"].held) == [(3,)]
    assert passed(handle, [0, 65_536, 199_999, 200_000, 10**15, -5]) == [-5, 200_000, 10**15]
    assert passed(handle, [-5, 7, 10**15, 10**15 + 1]) == [10**15 + 1]


def test_passes_each_offset_once_in_any_order():
    draw, handle, seen = random.Random(3), Handle(), set()
    for _ in range(20):
        batch = [draw.choice([draw.randrange(-300, 300), draw.randrange(2**62), 2**63 - 1, -2**63]) for _ in range(200)]
        found = passed(handle, batch, 30)
        assert sorted(found) == sorted(set(batch) - seen)
        seen |= set(batch)


def test_one_partition_is_dealt_over_all_shares(spark):
    rows = spark.range(-50_000, 150_000).select("id", seen_offsets.share_of(F.col("id"), 8).alias("share")).toPandas()
    rows["slot"] = seen_offsets.slots_in_share(rows["id"].to_numpy(np.int64), 8)
    assert not rows.duplicated(["share", "slot"]).any()
    for _, own in rows.groupby("share"):
        assert len(own) >= 24_000 and own["slot"].is_monotonic_increasing
        assert (np.diff(own["slot"]) > 1).sum() == 0  # no gaps where offsets have none
    assert rows["share"].nunique() == 8


def test_repeats_vanish_in_all_shares(spark, folder):
    ids = spark.range(0, 40_000, 3).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    out = []
    for batch in (ids.where("offset % 2 = 0"), ids.unionAll(ids.where("offset % 5 = 0")), ids):
        batch.write.mode("append").parquet(f"{folder}/in")
        records = spark.readStream.schema(ids.schema).parquet(f"{folder}/in")
        with conf(spark, kafka.state_settings(spark, 3)):
            jobs.write_lines(kafka.first_of_each(records, shares=5), f"{folder}/out", f"{folder}/checkpoint", once=True)
        out.append([r["offset"] for r in spark.read.schema(ids.schema).parquet(f"{folder}/out").collect()])
    assert sorted(out[0]) == list(range(0, 40_000, 6))
    assert sorted(out[1]) == sorted(out[2]) == list(range(0, 40_000, 3))


def test_batches_do_not_follow_the_tables_files(spark, folder):
    rows = spark.range(240).select(F.col("id").alias("event_id"), F.concat(F.lit("p"), "id").alias("props"))
    rows.repartition(24).write.parquet(f"{folder}/events.parquet")
    before = set(glob.glob(f"{shared_root(spark)}/penstock-*/stream-repeats-*"))
    with conf(spark, {"spark.sql.files.openCostInBytes": "128m"}):  # each file is a task
        assert spark.read.parquet(f"{folder}/events.parquet").rdd.getNumPartitions() == 24
        found = stream_queries.stream_first_records(spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted((i % 4, i, f"p{i}") for i in range(240))
    (own,) = set(glob.glob(f"{shared_root(spark)}/penstock-*/stream-repeats-*")) - before
    assert len(glob.glob(f"{own}/in/sending=*/*.parquet")) == len(glob.glob(f"{own}/checkpoint/commits/[0-9]*")) == 4


def test_places_of_odd_ids(spark):
    want = {"dev-events-3-12": ("dev-events", 3, 12), "a-1-2-3": ("a-1", 2, 3), "-0-1": ("", 0, 1),
            "a--1-2": ("a-", 1, 2), "é-00-007": ("é", 0, 7), "a-1-9999999999": ("a", 1, 9999999999), None: (None, None, None)}
    want |= {i: ("", None, None) for i in ["", "x", "1-2", "a-1-x", "a-1-2\n", "a\nb-1-2", "a-1-", "a-٣-4"]}
    rows = kafka.with_sent_place(spark.createDataFrame([(i, 1) for i in want], "record_id string, n int"))
    assert rows.columns == ["record_id", "n", "sent_topic", "sent_partition", "sent_offset"]
    assert {r["record_id"]: tuple(r)[2:] for r in rows.collect()} == want


def test_a_place_is_parsed_once_per_row(spark):
    rows = kafka.with_sent_place(spark.createDataFrame([("a-1-2",)], "record_id string"))
    plan = rows.where("sent_partition is not null and sent_offset > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1
