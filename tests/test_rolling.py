"""The rolling sink: every line lands once, files keep the roll size, nothing half-written shows."""

import gzip
import json
import pathlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from penstock.streaming import jobs, rolling


def files_of(path):
    return sorted(pathlib.Path(path).glob("load_date=*/*"))


def texts(path):
    return Counter((f.parent.name, line) for f in files_of(path)
                   for line in gzip.open(f, "rt", newline="\n").read().split("\n")[:-1])


def writer(folder, **options):
    return rolling.RollingWriter({"path": f"{folder}/out", "log": f"{folder}/log", **options})


def batch(*rows):
    columns = [pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["value", "load_date"])


def line_stream(spark, folder, rows=200, parts=3):
    lines = spark.range(rows).select(F.format_string("line %05d", "id").alias("value"),
                                     F.concat(F.lit("2024-01-0"), F.col("id") % 2 + 1).alias("load_date"))
    lines.repartition(parts).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    return lines, stream


def test_stream_rolls_by_size_and_restarts_add_nothing(spark, folder):
    lines, stream = line_stream(spark, folder)
    for _ in range(2):
        jobs.roll_stream(stream, f"{folder}/out", f"{folder}/checkpoint", roll_bytes=100, once=True)
        found = jobs.read_rolled(spark, f"{folder}/out")
        assert Counter(map(tuple, found.collect())) == Counter(map(tuple, lines.collect()))
    sizes = [len(gzip.open(f).read()) for f in files_of(f"{folder}/out")]
    assert max(sizes) <= 100 and len(sizes) >= 2200 // 100
    assert all(f.name.startswith("log_") and f.name.endswith(".txt.gz") for f in files_of(f"{folder}/out"))
    assert jobs.expire_days(spark, f"{folder}/out", "2024-01-02", keep_days=0) == ["2024-01-01"]
    assert jobs.read_rolled(spark, f"{folder}/out").count() == 100


def test_a_batch_cut_off_before_its_checkpoint_shows_once(spark, folder):
    lines, stream = line_stream(spark, folder, parts=2)
    jobs.roll_stream(stream, f"{folder}/out", f"{folder}/checkpoint", once=True)
    before = files_of(f"{folder}/out")
    pathlib.Path(folder, "checkpoint", "commits", "1").unlink()
    pathlib.Path(folder, "checkpoint", "commits", ".1.crc").unlink(missing_ok=True)
    jobs.roll_stream(stream, f"{folder}/out", f"{folder}/checkpoint", once=True)
    assert files_of(f"{folder}/out") == before
    assert jobs.read_rolled(spark, f"{folder}/out").count() == lines.count()


def test_a_failing_task_leaves_nothing_visible(spark, folder):
    _, stream = line_stream(spark, folder, parts=1)
    broken = stream.withColumn("value", F.when(F.col("value") == "line 00150", F.raise_error(F.lit("no")))
                               .otherwise(F.col("value")))
    with pytest.raises(Exception):
        jobs.roll_stream(broken, f"{folder}/out", f"{folder}/checkpoint", roll_bytes=100, once=True)
    assert files_of(f"{folder}/out") == []
    jobs.roll_stream(stream, f"{folder}/out", f"{folder}/checkpoint", roll_bytes=100, once=True)
    assert jobs.read_rolled(spark, f"{folder}/out").count() == 200
    assert list(pathlib.Path(folder, "out", "_open").rglob("*.gz")) == []


def test_few_tasks_give_few_files(spark, folder):
    _, stream = line_stream(spark, folder, parts=1)
    jobs.roll_stream(stream, f"{folder}/out", f"{folder}/checkpoint", prefix="app_", tasks=1, once=True)
    assert [f.name.startswith("app_") for f in files_of(f"{folder}/out")] == [True, True]


def test_commit_cut_off_between_moves_is_finished_by_the_next_attempt(folder):
    sink = writer(folder)
    first = sink.write(iter([batch(("a", "d1"), ("b", "d2"))]))
    sink._files([first], 0)
    pathlib.Path(folder, "out", "load_date=d1").mkdir(parents=True)
    name = first.files[0][0]
    pathlib.Path(folder, "out", sink.mine, name).rename(pathlib.Path(folder, f"out/load_date=d1/log_0-{name}.txt.gz"))
    sink.abort([first], 0)  # Spark aborts after a failed commit: what the note lists must stay
    again = sink.write(iter([batch(("a", "d1"), ("b", "d2"))]))
    sink.commit([again, None], 0)
    assert texts(f"{folder}/out") == {("load_date=d1", "a"): 1, ("load_date=d2", "b"): 1}
    assert list(pathlib.Path(folder, "out", sink.mine).iterdir()) == []


def test_an_aborted_batch_is_cleared_and_other_queries_files_stay(folder):
    sink, other = writer(folder), writer(folder, log=f"{folder}/log2")
    sink.write(iter([batch(("a", "d"))]))
    kept = other.write(iter([batch(("b", "d"))]))
    sink.abort([], 0)
    other.commit([kept], 0)
    assert texts(f"{folder}/out") == {("load_date=d", "b"): 1}


def test_notes_do_not_pile_up(folder):
    sink = writer(folder)
    for n in range(4):
        sink.commit([sink.write(iter([batch((str(n), "d"))]))], n)
    assert [f.name for f in pathlib.Path(folder, "log").iterdir()] == ["3.json"]
    assert json.loads(pathlib.Path(folder, "log", "3.json").read_text())[0][1] == "load_date=d"


def test_odd_values_and_days(spark, folder):
    sink = writer(folder, rollBytes="10")
    rows = [(None, "d"), ("", "d"), ("x" * 50, "d"), ("é中", "a/b=c"), ("y", None), ("z", "")]
    sink.commit([sink.write(iter([batch(*rows), batch()]))], 0)
    found = Counter(map(tuple, jobs.read_rolled(spark, f"{folder}/out").collect()))
    assert found == {("", "d"): 2, ("x" * 50, "d"): 1, ("é中", "a/b=c"): 1, ("y", None): 1, ("z", None): 1}


def test_an_empty_batch_writes_nothing(folder):
    sink = writer(folder)
    sink.commit([sink.write(iter([])), None], 0)
    assert files_of(f"{folder}/out") == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(st.characters(exclude_characters="\n\r", exclude_categories=["Cs"]), max_size=12),
                          st.sampled_from("abc")), max_size=30), st.integers(1, 40), st.integers(1, 3))
def test_rolled_files_hold_all_lines(tmp_path_factory, rows, roll_bytes, open_days):
    folder = tmp_path_factory.mktemp("roll")
    sink = writer(folder, rollBytes=str(roll_bytes), openDays=str(open_days))
    parts = [batch(*rows[i:i + 7]) for i in range(0, len(rows), 7)]
    sink.commit([sink.write(iter(parts))], 0)
    assert texts(f"{folder}/out") == Counter((f"load_date={d}", v) for v, d in rows)
    for f in files_of(f"{folder}/out"):
        data = gzip.open(f).read()
        assert len(data) <= roll_bytes or data.count(b"\n") == 1
