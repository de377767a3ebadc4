"""The keyed table: repeats, order of batches, compaction, cleaning, archiving."""

import random

import pytest
from pyspark.sql import types as T

from penstock.operators import lake
from penstock.streaming.lake_table import LakeTable

SCHEMA = T.StructType([
    T.StructField("app", T.StringType()), T.StructField("at", T.LongType()),
    T.StructField("text", T.StringType()), T.StructField("day", T.StringType()),
])
LOG = "app string, at long, text string, day string, seq long, gone boolean"


def new_table(spark, path):
    return LakeTable(spark, path, SCHEMA, ["app", "at", "day"], "at", "day", is_delete="gone")


def some_rows(seed, n=120):
    pick = random.Random(seed)
    out = []
    for seq in range(n):
        at = pick.randrange(12)
        # One key gets a third of all rows.
        app = "hot" if pick.random() < 1 / 3 else f"app{pick.randrange(4)}"
        at = 5 if app == "hot" else at
        out.append((app, at, f"text{seq}", f"2024-01-0{at % 3 + 1}", seq, pick.random() < 0.15))
    return out


def expected(rows):
    last = {}
    for app, at, text, day, _, gone in rows:
        last[app, at, day] = None if gone else text
    return sorted((a, at, t, d) for (a, at, d), t in last.items() if t is not None)


def content(df):
    return sorted(tuple(r) for r in df.select("app", "at", "text", "day").collect())


def add(spark, table, rows, sizes, first=0, compact_after=()):
    start = 0
    for n, size in enumerate(sizes, first):
        table.upsert(spark.createDataFrame(rows[start:start + size], LOG), n)
        start += size
        if n in compact_after:
            table.compact()


@pytest.mark.parametrize("seed, sizes, compact_after", [
    (1, [120], ()), (1, [40, 40, 40], ()), (1, [40, 40, 40], (0, 2)), (2, [1, 100, 19], (1,)), (3, [60, 60], (0, 1)),
])
def test_content_does_not_depend_on_batches_or_compaction(spark, folder, seed, sizes, compact_after):
    rows = some_rows(seed)
    table = new_table(spark, folder)
    add(spark, table, rows, sizes, compact_after=compact_after)
    assert content(table.snapshot()) == expected(rows)


def test_repeated_batch_changes_nothing(spark, folder):
    rows = some_rows(4)
    table = new_table(spark, folder)
    add(spark, table, rows, [60, 60])
    table.upsert(spark.createDataFrame(rows[60:], LOG), 1)
    assert content(table.snapshot()) == expected(rows)
    table.compact()
    table.upsert(spark.createDataFrame(rows[:60], LOG), 0)
    assert content(table.snapshot()) == expected(rows)


def test_writers_that_count_alike_do_not_replace_each_other(spark, folder):
    rows = some_rows(9)
    table = new_table(spark, folder)
    part = [spark.createDataFrame(rows[i:i + 40], LOG) for i in (0, 40, 80)]
    table.upsert(part[0], 0, "first")
    table.compact()
    table.upsert(part[1], 0, "second")
    table.upsert(part[1], 0, "second")
    table.upsert(part[2], 1, "first")
    table.upsert(part[0], 0, "first")
    assert table.batches() == [0, 1, 2]
    assert content(table.snapshot()) == expected(rows)


def test_repeat_after_cleaning_does_not_bring_old_rows_back(spark, folder):
    rows = some_rows(11)
    table = new_table(spark, folder)
    early, late = (spark.createDataFrame(r, LOG) for r in (rows[:60], rows[60:]))
    table.upsert(early, 0, "first")
    table.upsert(late, 0, "second")
    table.compact()
    assert table.clean(1) == ["log/batch=0", "log/batch=1"]
    assert table.upsert(early, 0, "first") is False
    assert content(table.snapshot()) == expected(rows)


def test_batch_begun_but_overtaken_counts_as_new(spark, folder):
    rows = some_rows(10)
    table = new_table(spark, folder)
    assert table.claim("first", 0) == 0
    table.upsert(spark.createDataFrame(rows[:60], LOG), 0, "second")
    table.compact()
    table.upsert(spark.createDataFrame(rows[60:], LOG), 0, "first")
    assert table.batches() == [1, 2]
    assert content(table.snapshot()) == expected(rows)


def test_compacting_twice_is_compacting_once(spark, folder):
    rows = some_rows(5)
    table = new_table(spark, folder)
    add(spark, table, rows, [60, 60])
    assert table.compact() == 1
    before = content(table.snapshot())
    assert table.compact() is None
    assert content(table.snapshot()) == before == expected(rows)


def test_unfinished_batch_is_invisible(spark, folder):
    import pathlib
    rows = some_rows(6)
    table = new_table(spark, folder)
    add(spark, table, rows, [60, 60])
    pathlib.Path(folder, "log/batch=1/_SUCCESS").unlink()
    assert content(table.snapshot()) == expected(rows[:60])


def test_compaction_rewrites_touched_partitions_only(spark, folder):
    table = new_table(spark, folder)
    row = lambda day, seq, text: ("a", 1, text, day, seq, False)
    table.upsert(spark.createDataFrame([row("d1", 1, "x"), row("d2", 2, "x")], LOG), 0)
    table.compact()
    table.upsert(spark.createDataFrame([row("d2", 3, "y")], LOG), 1)
    table.compact()
    assert table.state().base == {"day=d1": 0, "day=d2": 1}
    assert content(table.snapshot()) == [("a", 1, "x", "d1"), ("a", 1, "y", "d2")]


def test_empty_table_and_empty_batch(spark, folder):
    table = new_table(spark, folder)
    assert content(table.snapshot()) == []
    assert table.compact() is None
    table.upsert(spark.createDataFrame([], LOG), 0)
    assert content(table.snapshot()) == []
    table.compact()
    assert content(table.snapshot()) == []


@pytest.mark.parametrize("retained", [1, 2, 4, 9])
def test_clean_keeps_what_retained_commits_read(spark, folder, retained):
    rows = some_rows(7)
    table = new_table(spark, folder)
    add(spark, table, rows, [20] * 6, compact_after=(1, 3, 4))
    commits = table.batches()
    kept = commits[-retained:] if retained <= len(commits) else commits
    before = {c: content(table.snapshot(as_of=c)) for c in kept}
    removed = table.clean(retained)
    assert {c: content(table.snapshot(as_of=c)) for c in kept} == before
    assert content(table.snapshot()) == expected(rows)
    assert bool(removed) == (retained < 6)


def test_archive_stays_between_bounds(spark, folder):
    rows = some_rows(8)
    table = new_table(spark, folder)
    add(spark, table, rows, [20] * 6, compact_after=range(6))
    assert table.archive(keep_min=2, keep_max=6) == []
    assert table.archive(keep_min=2, keep_max=5) == [0, 1, 2, 3]
    assert table.versions() == [4, 5]
    assert content(table.snapshot()) == expected(rows)
    archived = spark.read.parquet(f"{folder}/archive/upto=3")
    assert archived.select("archived_from").distinct().count() == 4
    # The last batch is still known after its numbers were tidied up.
    table.upsert(spark.createDataFrame(rows[100:], LOG), 5)
    assert table.batches()[-1] == 5


def test_ordering_column_must_be_in_the_key(spark, folder):
    with pytest.raises(ValueError):
        LakeTable(spark, folder, SCHEMA, ["app"], "at", "day")


def test_clean_plan_by_hand(spark):
    versions = spark.createDataFrame(
        [(1, "g", c) for c in (1, 3, 5, 7)] + [(1, "h", 1), (1, "h", 7)] + [(2, "g", 1), (2, "g", 2)],
        "table_id int, file_group string, commit long")
    limits = spark.createDataFrame([(1, 2), (2, 3)], "table_id int, commits_retained int")
    oldest = lake.oldest_retained(versions, limits)
    assert [tuple(r) for r in oldest.collect()] == [(1, 5)]
    plan = lake.clean_plan(versions, oldest)
    assert sorted(tuple(r) for r in plan.collect()) == [(1, "g", 1), (1, "g", 3)]


def test_archive_plan_by_hand(spark):
    commits = spark.createDataFrame([(1, c) for c in range(10)] + [(2, c) for c in range(5)], "table_id int, commit long")
    limits = spark.createDataFrame([(1, 3, 6), (2, 3, 6)], "table_id int, keep_min int, keep_max int")
    plan = lake.archive_plan(commits, limits)
    assert sorted(tuple(r) for r in plan.collect()) == [(1, c) for c in range(7)]
