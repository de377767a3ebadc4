import pytest
from pyspark.sql import functions as F

from penstock import upkeep
from penstock.functions import logs
from penstock.operators import maintenance
from penstock.plans import fixtures
from penstock.sources import delimited, folders
from penstock.streaming import jobs

NAMES = [("db.t", ("db", "t")), ("db.t.x", ("db", "t.x")), ("nodot", None), (".t", None), ("db.", None), ("", None),
         (None, None)]


def config(spark, rows):
    """Config rows from (full_table_name, threshold, priority)."""
    given = spark.createDataFrame(rows, "full_table_name string, compaction_commit_threshold int, priority_level int")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in maintenance.CONFIG_SCHEMA if f.name not in given.columns]
    return given.select("*", *missing)


@pytest.mark.parametrize("name, parts", NAMES)
def test_names(spark, name, parts):
    row = maintenance.with_names(config(spark, [(name, 1, 1)])).first()
    assert (row["schema_name"], row["table_name"]) == (parts or (None, None))


def test_parsed_and_rejected_are_the_whole(spark):
    rows = config(spark, [(n, 1, 1) for n, _ in NAMES] + [("db.t", None, 1)])
    parsed, rejected = maintenance.parsed_config(rows), maintenance.rejected_config(rows)
    assert parsed.count() == 2
    assert sorted(r["reason"] for r in rejected.collect()) == ["invalid table name"] * 5 + ["missing threshold"]


def test_limits(spark):
    row = maintenance.with_upkeep_limits(config(spark, [("db.t", 5, 1)])).first()
    assert (row["commits_retained"], row["keep_min"], row["keep_max"]) == (10, 11, 31)


@pytest.mark.parametrize("given, dynamic", [("true", True), ("TRUE", False), ("false", False), (None, False)])
def test_dynamic_only_when_exactly_true(spark, given, dynamic):
    rows = config(spark, [("db.t", 5, 1)]).withColumn("spark_dynamic_allocation", F.lit(given).cast("string"))
    row = maintenance.with_resources(rows).first()
    assert row["dynamic"] is dynamic
    assert (row["executor_instances"], row["min_executors"]) == ((None, 1) if dynamic else (2, None))


def test_run_order_and_preview(spark, sf_dir):
    active = maintenance.active_config(fixtures.maintenance_config(fixtures.table(spark, sf_dir, "part")))
    ordered = [(r["priority_level"], r["full_table_name"]) for r in maintenance.by_priority(active).collect()]
    assert ordered == sorted(ordered)
    assert [(r["priority_level"], r["full_table_name"]) for r in maintenance.preview(active).collect()] == ordered[:3]
    assert maintenance.has_rows(active) and not maintenance.has_rows(active.where("false"))


def test_empty_cells_keep_their_place(spark, folder):
    rows = config(spark, [("db.t", 3, 1), ("db.u", None, 2)]).select(*maintenance.CONFIG_COLUMNS)
    delimited.write_tsv(rows, f"{folder}/tsv")
    back = delimited.read_tsv(spark, f"{folder}/tsv", maintenance.CONFIG_SCHEMA)
    assert sorted(back.collect()) == sorted(rows.collect())


@pytest.mark.parametrize("line, found", [
    ("x application_1700000000000_0001 y", "application_1700000000000_0001"),
    ("application_1700000000000_12345", "application_1700000000000_12345"),
    ("application_17_0001", None),
])
def test_application_id(spark, line, found):
    lines = spark.createDataFrame([(1, 0, 1, line)], "run_id int, file_rank int, line_no int, line string")
    assert maintenance.application_ids(lines).first()["application_id"] == found


def test_summary_of_failures(spark):
    rows = spark.createDataFrame([("SUCCESS",), ("FAILED",)], "status string")
    assert tuple(maintenance.run_summary(rows).first()) == (2, 1, 1, False)
    assert maintenance.run_summary(rows.where("status = 'SUCCESS'")).first()["all_ok"] is True


def test_run_continues_after_a_failure_and_records_status(spark, folder, monkeypatch):
    monkeypatch.setattr(upkeep, "FLUSH_EVERY", 2)
    rows = config(spark, [("db.slow", 1, 9), ("db.bad", 1, 2), ("db.first", 1, 1), ("nodot", 1, 0), ("db.none", None, 0)])
    status = [F.lit(None).cast("string").alias(c) for c in
              ("last_compaction_time", "last_compaction_status", "yarn_application_id", "updated_time", "updated_by")]
    folders.write_next(rows.select("*", *status), f"{folder}/config")
    done = []

    def body(row):
        done.append(row["full_table_name"])
        if row["full_table_name"] == "db.bad":
            raise RuntimeError("broken")

    outcomes = upkeep.run_plan(folders.read_newest(spark, f"{folder}/config"), body, f"{folder}/outcomes")
    assert done == ["db.first", "db.bad", "db.slow"]
    assert tuple(maintenance.run_summary(outcomes).first()) == (3, 2, 1, False)
    upkeep.record_status(spark, f"{folder}/config", outcomes,
                         as_of=F.lit("2024-02-01 12:00:00").cast("timestamp"))
    after = {r["full_table_name"]: r for r in folders.read_newest(spark, f"{folder}/config").collect()}
    assert len(after) == 5
    assert after["db.bad"]["last_compaction_status"] == "FAILED" and after["db.bad"]["yarn_application_id"] == ""
    assert after["db.first"]["last_compaction_status"] == "SUCCESS"
    assert after["db.first"]["yarn_application_id"] == spark.sparkContext.applicationId
    assert after["db.first"]["updated_by"] == "SYSTEM_AUTO"
    assert after["nodot"]["last_compaction_status"] is None


def test_upkeep_of_real_tables(spark, sf_dir, folder):
    raw = logs.normalize_logs(fixtures.app_logs(fixtures.table(spark, sf_dir, "events")), "seq")
    table = jobs.lake_table(spark, f"{folder}/t")
    for n in range(3):
        table.upsert(logs.log_rows(raw.where(F.col("seq") % 3 == n)), n)
    before = table.snapshot().collect()
    outcomes = upkeep.run_plan(config(spark, [("db.t", 1, 1)]), upkeep.table_upkeep(lambda row: table),
                               f"{folder}/outcomes")
    assert [r["status"] for r in outcomes.collect()] == ["SUCCESS"]
    assert table.versions() == [2]
    assert sorted(table.snapshot().collect(), key=str) == sorted(before, key=str)


def test_statements_for_a_deployed_format(spark):
    rows = maintenance.with_upkeep_limits(config(spark, [("db.t", 5, 1), ("db.t; drop table x", 5, 1)])).collect()
    statements = upkeep.upkeep_statements(rows[0])
    assert statements[-3:] == ["run compaction on db.t", "run clean on db.t", "run archivelog on db.t"]
    assert "set hoodie.cleaner.commits.retained = 10" in statements
    assert "set hoodie.keep.max.commits = 31" in statements
    with pytest.raises(ValueError):
        upkeep.upkeep_statements(rows[1])


def test_a_shorter_second_run_has_its_own_outcomes(spark, folder):
    for names in (["db.a", "db.b", "db.c"], ["db.a"]):
        plan = config(spark, [(n, 1, 1) for n in names])
        outcomes = upkeep.run_plan(plan, lambda row: None, f"{folder}/outcomes")
        assert sorted(r["table_name"] for r in outcomes.collect()) == [n[3:] for n in names]


def test_stored_names_are_kept(spark, folder):
    rows = config(spark, [("odd", 1, 1), ("db.t", 1, 2)]).withColumns({
        "schema_name": F.when(F.col("full_table_name") == "odd", F.lit("s2")),
        "table_name": F.when(F.col("full_table_name") == "odd", F.lit("t2"))})
    status = [F.lit(None).cast("string").alias(c) for c in
              ("last_compaction_time", "last_compaction_status", "yarn_application_id", "updated_time", "updated_by")]
    folders.write_next(rows.select("*", *status), f"{folder}/config")
    outcomes = upkeep.run_plan(folders.read_newest(spark, f"{folder}/config"), lambda row: None, f"{folder}/outcomes")
    upkeep.record_status(spark, f"{folder}/config", outcomes)
    after = {r["full_table_name"]: r for r in folders.read_newest(spark, f"{folder}/config").collect()}
    assert (after["odd"]["schema_name"], after["odd"]["table_name"]) == ("s2", "t2")
    assert {r["last_compaction_status"] for r in after.values()} == {"SUCCESS"}
