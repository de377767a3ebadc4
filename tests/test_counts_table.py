"""The table of stream counts: each batch once, all batches of a query that ended, failures kept apart."""

import datetime
import pathlib

from pyspark.sql import functions as F

from penstock.operators import counters
from penstock.streaming import jobs


def numbers(spark, folder, parts=3):
    spark.range(90).repartition(parts).write.parquet(f"{folder}/in")
    return spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def run(spark, frame, folder, table="counts"):
    with counters.kept_counts(spark, f"{folder}/{table}") as keeper:
        query = jobs.write_lines(frame, f"{folder}/out", f"{folder}/checkpoint", once=True)
        assert keeper.wait(query)
    return keeper, query


def counted(numbers):
    return counters.observed_stream(numbers, "n", F.col("id") % 2 == 0)


def test_batches_of_a_query_are_readable_afterwards(spark, folder):
    keeper, query = run(spark, counted(numbers(spark, folder)), folder)
    found = counters.read_counts(spark, f"{folder}/counts").orderBy("batch").collect()
    assert keeper.failed == []
    assert [(r["batch"], r["name"], r["query"]) for r in found] == [(b, "n", str(query.id)) for b in range(3)]
    assert sum(r["counts"]["rows"] for r in found) == sum(r["input_rows"] for r in found) == 90
    assert sum(r["counts"]["ok_rows"] for r in found) == 45
    assert all(isinstance(r["at"], datetime.datetime) and str(r["at"])[:10] == r["day"] for r in found)


def test_a_repeated_batch_counts_once(spark, folder):
    # The rolling sink takes a repeated batch's rows again, where parquet files skip it.
    stream = counted(numbers(spark, folder)).selectExpr("cast(id as string) value", "'d' load_date")

    def again():
        with counters.kept_counts(spark, f"{folder}/counts") as keeper:
            assert keeper.wait(jobs.roll_stream(stream, f"{folder}/out", f"{folder}/checkpoint", once=True))

    again()
    first = {r["batch"]: r["at"] for r in counters.read_counts(spark, f"{folder}/counts").collect()}
    for name in ("2", ".2.crc"):
        pathlib.Path(folder, "checkpoint", "commits", name).unlink(missing_ok=True)
    again()
    assert jobs.read_rolled(spark, f"{folder}/out").count() == 90
    found = counters.read_counts(spark, f"{folder}/counts").collect()
    assert spark.read.schema(counters.COUNTS_SCHEMA).parquet(f"{folder}/counts").count() == 4
    assert sum(r["counts"]["rows"] for r in found) == 90
    assert {r["batch"] for r in found if r["at"] > first[r["batch"]]} == {2}


def test_several_names_and_queries_without_counts(spark, folder):
    both = counters.observed_stream(counted(numbers(spark, folder, 1)), "again")
    run(spark, both, folder)
    assert {r["name"]: r["counts"]["rows"] for r in counters.read_counts(spark, f"{folder}/counts").collect()} == {
        "n": 90, "again": 90}
    plain = f"{folder}/plain"
    run(spark, numbers(spark, plain, 1), plain)
    assert [(r["name"], r["input_rows"], r["counts"]) for r in counters.read_counts(spark, f"{plain}/counts").collect()] \
        == [("", 90, {})]


def test_no_input_gives_an_empty_table(spark, folder):
    stream = numbers(spark, folder, 1).where("false")
    run(spark, counters.observed_stream(stream, "none"), folder)
    found = counters.read_counts(spark, f"{folder}/counts").collect()
    assert [(r["input_rows"], r["counts"]) for r in found] == [(90, {"rows": 0})]
    assert counters.read_counts(spark, f"{folder}/nothing").count() == 0


def test_a_table_that_cannot_be_written_stops_no_query(spark, folder):
    pathlib.Path(folder, "counts").write_text("a file")
    keeper, query = run(spark, counted(numbers(spark, folder)), folder)
    assert query.exception() is None
    assert [batch for _, batch, _ in keeper.failed] == [0, 1, 2]
