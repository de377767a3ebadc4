"""Tailing: ranges, appends, restarts, replaced files, capped batches."""

import pathlib

import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from penstock.sources import tail
from penstock.streaming import jobs


def write(folder, name, data: bytes, mode="wb"):
    path = pathlib.Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode) as f:
        f.write(data)
    return str(path)


def lines_of(batches):
    return [(r["value"], r["position"]) for b in batches for r in b.to_pylist()]


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.binary(max_size=60).map(lambda b: bytes(b"\nab"[x % 3] for x in b)), chunk=st.integers(1, 20),
       block=st.integers(1, 7))
def test_pieces_give_each_line_once(tmp_path_factory, data, chunk, block):
    path = write(tmp_path_factory.mktemp("t"), "x.log", data)
    old, tail.BLOCK_BYTES = tail.BLOCK_BYTES, block
    try:
        found = [x for p in tail.split_range(path, 0, len(data), chunk) for x in lines_of(tail.read_range(path, p))]
    finally:
        tail.BLOCK_BYTES = old
    want, at = [], 0
    for line in data.split(b"\n")[:-1]:
        want.append((line.decode(), at))
        at += len(line) + 1
    assert found == want


def test_odd_bytes_and_end_marks(tmp_path):
    data = b"ok\r\n\r\na\rb\n\xff\xfe\n\xc3\xa9\n"
    path = write(tmp_path, "x.log", data)
    (part,) = tail.split_range(path, 0, len(data), 1000)
    assert lines_of(tail.read_range(path, part)) == [
        ("ok", 0), ("", 4), ("a\rb", 6), ("\ufffd\ufffd", 10), ("é", 13)]


def test_batch_read_leaves_the_unfinished_line(spark, folder):
    write(folder, "a.log", b"one\r\ntwo\nthr")
    write(folder, "sub/b.log", "größe\n\n".encode())
    write(folder, "c.txt", b"no\n")
    rows = tail.read(spark, folder, chunkBytes=3).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["value"]) for r in rows) == [
        ("a.log", "one"), ("a.log", "two"), ("b.log", ""), ("b.log", "größe")]


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.binary(max_size=60).map(lambda b: bytes(b"\nab"[x % 3] for x in b)), count=st.integers(1, 6),
       block=st.integers(1, 7))
def test_last_lines_are_those_of_the_whole_file(tmp_path_factory, data, count, block):
    path = write(tmp_path_factory.mktemp("t"), "x.log", data)
    old, tail.END_BLOCK_BYTES = tail.END_BLOCK_BYTES, block
    try:
        found = lines_of(tail.read_range(path, tail.FileRange(path, 0, len(data), count)))
    finally:
        tail.END_BLOCK_BYTES = old
    assert found == lines_of(tail.read_range(path, tail.FileRange(path, 0, len(data))))[-count:]


def test_last_lines_read_the_end_only(tmp_path, monkeypatch):
    path = write(tmp_path, "x.log", b"line\n" * 1_000_000 + b"unfinished")
    taken = []

    class Counting:
        def __init__(self, handle):
            self.handle = handle

        def seek(self, at):
            self.handle.seek(at)

        def read(self, size):
            taken.append(size)
            return self.handle.read(size)

    size = pathlib.Path(path).stat().st_size
    with open(path, "rb") as handle:
        assert tail.last_start(Counting(handle), size, 3) == 999_997 * 5
    assert sum(taken) == tail.END_BLOCK_BYTES


def test_last_lines_of_files(spark, folder):
    write(folder, "a.log", b"one\r\ntwo\nthree\nfo")
    write(folder, "b.log", b"only\n")
    write(folder, "c.log", b"")
    rows = tail.read(spark, folder, lastLines=2).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["value"], r["position"]) for r in rows) == [
        ("a.log", "three", 9), ("a.log", "two", 5), ("b.log", "only", 0)]
    with pytest.raises(Exception, match="lastLines is for batches"):
        tail.read_stream(spark, folder, lastLines=2).writeStream.format("noop").trigger(
            availableNow=True).start().awaitTermination()


@pytest.mark.parametrize("condition, names", [
    ("endswith(file, 'b.log')", ["b.log"]), ("contains(file, '/sub/')", ["c.log", "d.log"]),
    ("file LIKE '%/a.log'", ["a.log"]), ("contains(file, 'log') AND value = 'y'", ["b.log", "d.log"]),
    ("NOT endswith(file, 'b.log')", ["a.log", "c.log", "d.log"]), ("endswith(file, 'none')", []),
    ("endswith(file, 'a.log') OR value = 'y'", ["a.log", "b.log", "d.log"]),
])
def test_filters_on_files(spark, folder, condition, names):
    for name, data in [("a.log", b"x\n"), ("b.log", b"y\n"), ("sub/c.log", b"x\n"), ("sub/d.log", b"y\n")]:
        write(folder, name, data)
    rows = tail.read(spark, folder).where(condition).collect()
    assert sorted(r["file"].rsplit("/", 1)[1] for r in rows) == names


def test_an_empty_folder_has_no_lines(spark, folder):
    assert tail.read(spark, folder).count() == 0


def test_files_that_a_filter_leaves_out_are_not_opened(spark, folder):
    paths = [write(folder, f"{name}.log", b"x\n") for name in "abcd"]
    lines = tail.read(spark, folder)
    assert lines.rdd.getNumPartitions() == 4
    for chosen, count in [(lines.where(lines.file == paths[1]), 1), (lines.where(lines.file.isin(paths[:3])), 3),
                          (lines.where(lines.file.startswith(paths[0][:-5])), 4), (lines.where("contains(file, 'd.l')"), 1)]:
        assert chosen.rdd.getNumPartitions() == count == chosen.count()


def follow(spark, folder, **options):
    lines = tail.read_stream(spark, f"{folder}/in", **options)
    jobs.drain(jobs.write_lines(lines, f"{folder}/out", f"{folder}/checkpoint", interval="0 seconds"))
    rows = spark.read.schema(tail.SCHEMA).parquet(f"{folder}/out").collect()
    return sorted((r["file"].rsplit("/", 1)[1], r["position"], r["value"]) for r in rows)


def test_appended_lines_arrive_once_over_restarts(spark, folder):
    write(folder, "in/a.log", b"one\ntw")
    assert follow(spark, folder) == [("a.log", 0, "one")]
    write(folder, "in/a.log", b"o\nthree\n", "ab")
    write(folder, "in/b.log", b"new\n")
    want = [("a.log", 0, "one"), ("a.log", 4, "two"), ("a.log", 8, "three"), ("b.log", 0, "new")]
    assert follow(spark, folder) == want
    assert follow(spark, folder) == want


def test_available_now_takes_everything_when_uncapped(spark, folder):
    write(folder, "in/a.log", b"1\n2\n")
    for want in (["1", "2"], ["1", "2", "3"]):
        lines = tail.read_stream(spark, f"{folder}/in", chunkBytes=1)
        jobs.write_lines(lines, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
        rows = spark.read.schema(tail.SCHEMA).parquet(f"{folder}/out").collect()
        assert sorted(r["value"] for r in rows) == want
        write(folder, "in/a.log", b"3\n", "ab")


def test_replaced_file_starts_again(spark, folder):
    write(folder, "in/a.log", b"one\ntwo\nthree\n")
    follow(spark, folder)
    write(folder, "in/a.log", b"fresh\n")
    assert ("a.log", 0, "fresh") in follow(spark, folder)


def test_capped_batches_deliver_everything(spark, folder):
    text = [f"line {i:04d}" for i in range(300)]
    write(folder, "in/a.log", ("\n".join(text) + "\n").encode())
    found = follow(spark, folder, maxBytesPerFile=700, chunkBytes=100)
    assert [v for _, _, v in found] == text


def test_running_query_follows_a_growing_file(spark, folder):
    write(folder, "in/a.log", b"1\n2\n")
    lines = tail.read_stream(spark, f"{folder}/in", maxBytesPerFile=3)
    query = jobs.write_lines(lines, f"{folder}/out", f"{folder}/checkpoint", interval="0 seconds")
    try:
        query.processAllAvailable()
        write(folder, "in/a.log", b"3\n4\n5\n", "ab")
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.schema(tail.SCHEMA).parquet(f"{folder}/out").collect()
    assert sorted(r["value"] for r in rows) == ["1", "2", "3", "4", "5"]


def once(spark, folder, **options):
    lines = tail.read_stream(spark, f"{folder}/in", **options)
    query = jobs.write_lines(lines, f"{folder}/out", f"{folder}/checkpoint", once=True)
    rows = spark.read.schema(tail.SCHEMA).parquet(f"{folder}/out").collect()
    return query, sorted((r["file"].rsplit("/", 1)[1], r["position"], r["value"]) for r in rows)


@pytest.mark.parametrize("cap", ["maxBytesPerFile", "maxBytesPerTrigger"])
def test_a_line_longer_than_the_cap_hides_nothing(spark, folder, cap):
    lines = ["x" * 200, *(f"line {i}" for i in range(21))]
    write(folder, "in/a.log", ("\n".join(lines) + "\n").encode())
    _, found = once(spark, folder, **{cap: 50})
    assert [v for _, _, v in found] == lines
    write(folder, "in/a.log", b"more\n", "ab")
    _, found = once(spark, folder, **{cap: 2})
    assert [v for _, _, v in found] == [*lines, "more"]


def test_no_file_starves_another(spark, folder):
    write(folder, "in/big.log", b"".join(b"big %03d\n" % i for i in range(200)))
    for i in range(3):
        write(folder, f"in/small{i}.log", b"one\ntwo\n")
    reader = tail.TailStreamReader(tail._TailOptions({"path": f"{folder}/in", "maxBytesPerTrigger": "100"}))
    first = reader.latestOffset()
    taken = {f.rsplit("/", 1)[1]: e["to"] - e["from"] for f, e in first.items()}
    assert taken == {"small0.log": 8, "small1.log": 8, "small2.log": 8, "big.log": 76}
    query, found = once(spark, folder, maxBytesPerTrigger=400)
    assert len(found) == 206


def test_shares_are_fair_and_use_the_budget():
    assert tail.fair_shares({"a": 5, "b": 100, "c": 100}, 65) == {"a": 5, "b": 30, "c": 30}
    assert tail.fair_shares({"a": 5, "b": 7}, 100) == {"a": 5, "b": 7}
    assert tail.fair_shares({"a": 5, "b": 7, "c": 9}, 1) == {"a": 1, "b": 1, "c": 1}


def test_a_longer_replacement_is_read_from_its_start(spark, folder):
    write(folder, "in/a.log", b"one\ntwo\n")
    once(spark, folder)
    write(folder, "in/a.log", b"fresh one\nfresh two\nfresh three\n")
    _, found = once(spark, folder)
    assert found == [("a.log", 0, "fresh one"), ("a.log", 0, "one"), ("a.log", 4, "two"), ("a.log", 10, "fresh two"),
                     ("a.log", 20, "fresh three")]


def test_a_renamed_file_goes_on_and_gone_files_are_forgotten(spark, folder):
    write(folder, "in/a.log", b"one\ntwo\n")
    write(folder, "in/b.log", b"other\n")
    once(spark, folder)
    pathlib.Path(folder, "in/a.log").rename(pathlib.Path(folder, "in/a1.log"))
    pathlib.Path(folder, "in/b.log").unlink()
    write(folder, "in/a1.log", b"three\n", "ab")
    write(folder, "in/a.log", b"new\n")
    query, found = once(spark, folder)
    assert found == [("a.log", 0, "new"), ("a.log", 0, "one"), ("a.log", 4, "two"), ("a1.log", 8, "three"),
                     ("b.log", 0, "other")]
    offset = query.lastProgress["sources"][0]["endOffset"]
    assert "b.log" not in str(offset) and "a1.log" in str(offset)


def test_a_file_shorter_than_listed_is_an_error(tmp_path):
    path = write(tmp_path, "x.log", b"one\n")
    with pytest.raises(EOFError):
        list(tail.read_range(path, tail.FileRange(path, 0, 10)))
