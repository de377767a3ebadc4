"""What the plans must look like to hold at scale."""

import re

import __spark_entry__ as entry
import pytest

QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"\bExchange\b", text))


@pytest.mark.parametrize("name", [
    "device_report_full", "device_report_short", "device_client_report", "device_quarantine", "device_serialize",
    "props_parse", "log_normalize", "log_rejects", "log_file_name", "log_severity", "message_size_guard",
    "path_safety", "config_parsed", "config_rejected", "compaction_params", "resource_plan", "log_tail_lines",
])
def test_row_by_row_work_moves_no_rows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert exchanges(text) == 0 and "Python" not in text and "Sort" not in text


@pytest.mark.parametrize("name", ["log_lake_upsert", "error_tail", "batch_counts", "retention_plan", "app_id_extract",
                                  "config_active_ordered", "maintenance_summary", "record_repeats"])
def test_one_exchange(spark, sf_dir, name):
    assert exchanges(plan(QUERIES[name](spark, sf_dir))) == 1


@pytest.mark.parametrize("name", ["log_lake_upsert", "error_tail", "lake_compact", "maintenance_status"])
def test_rows_per_key_are_limited_before_the_exchange(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert re.search(r"WindowGroupLimit [^\n]*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit [^\n]*Partial", text)


@pytest.mark.parametrize("name", ["device_client_report", "log_normalize", "log_rejects"])
def test_json_is_parsed_once(spark, sf_dir, name):
    assert plan(QUERIES[name](spark, sf_dir)).count("from_json(") == 1


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_scans_read_only_the_columns_used(spark, sf_dir):
    text = plan(QUERIES["lake_clean_plan"](spark, sf_dir))
    assert "struct<l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in text
    text = plan(QUERIES["batch_counts"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_base_is_not_moved_when_the_log_is_small(spark, folder):
    from penstock.operators import lake
    spark.range(200_000).selectExpr("id as k", "id as v", "0L as seq").write.parquet(f"{folder}/base")
    spark.range(1000).selectExpr("id * 3 as k", "id as v", "id as seq").write.parquet(f"{folder}/log")
    base, log = spark.read.parquet(f"{folder}/base"), spark.read.parquet(f"{folder}/log")
    merged = lake.merge_on_read(base, log, ["k"], ["seq"])
    merged.write.format("noop").mode("overwrite").save()
    assert "BroadcastHashJoin" in plan(merged) and "SortMergeJoin" not in plan(merged)


@pytest.mark.parametrize("repeats", [True, False])
def test_unique_log_keys_are_not_made_distinct(spark, folder, repeats):
    from penstock.operators import lake
    spark.range(1000).selectExpr("id as k", "id as v", "0L as seq").write.parquet(f"{folder}/base")
    spark.range(100).selectExpr("id * 3 as k", "id as v", "id as seq").write.parquet(f"{folder}/log")
    base, log = spark.read.parquet(f"{folder}/base"), spark.read.parquet(f"{folder}/log")
    merged = lake.merge_on_read(base, log, ["k"], ["seq"], log_has_repeats=repeats)
    assert ("HashAggregate" in plan(merged)) == repeats
    assert merged.count() == 1000


def test_the_program_layer_moves_no_more_rows(spark, sf_dir):
    from penstock.operators import settings
    from penstock.plans import settings_queries
    defaults, overrides = settings_queries._tables(spark, sf_dir)
    topics = settings_queries._topics(defaults, overrides)

    def moved(code):
        df = settings.effective(topics, defaults, overrides, code=code)
        df.collect()
        final = plan(df).split("Initial Plan")[0]
        return len(re.findall(r"(?<!Reused)Exchange ", final))

    assert moved(settings_queries.CODE) <= moved(None)
