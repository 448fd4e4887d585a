"""What the plans of the queries must and must not hold."""

import pytest

from khodat.checks import QUERIES

SF = "/root/testdata/sf0.001"
# Queries over one table that change or drop rows one by one: no shuffle at all.
MAP_ONLY = [
    "select_columns", "audit_columns", "extract_with_filter", "extract_with_server_key", "date_filter", "apply_schema",
    "staging_type_relax", "export_type_widen", "drop_string_columns", "sentinel_to_null", "resolve_link",
    "business_date", "parse_date", "format_date", "date_range", "yesterday", "datetime_to_epoch", "epoch_to_datetime",
    "midnight_tz_to_utc", "day_partition", "next_workday", "previous_workday_interval", "next_run_interval",
    "extract_html_field_pages", "extract_html_links_pages", "union_pages",
]
NO_WRITES = MAP_ONLY + [
    "count_rows", "distinct_rows", "partition_count", "newest_file", "expire_snapshots", "orphan_files",
    "date_dimension", "extract_ward", "total_price", "warehouse_transform", "rename_column", "null_to_sentinel",
    "extract_html_field", "extract_html_links", "listing_ingest",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    """The joins as they are planned for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", MAP_ONLY)
def test_row_by_row_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", NO_WRITES)
def test_no_nested_loops_and_no_single_partition_sorts(without_broadcast, name):
    text = plan(QUERIES[name](without_broadcast, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "BatchEvalPython"):
        assert operator not in text
    if "SinglePartition" in text:  # only for an aggregate over everything, already reduced by each task
        assert "partial_" in text and "Window" not in text


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(QUERIES["date_filter"](spark, SF))
    assert "LessThan(o_orderdate" in plan(QUERIES["orphan_files"](spark, SF))
    assert "GreaterThan(o_totalprice" in plan(QUERIES["extract_with_filter"](spark, SF))


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["orphan_files"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_newest_snapshots_are_picked_before_the_shuffle(without_broadcast):
    lines = plan(QUERIES["expire_snapshots"](without_broadcast, SF)).splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    assert any("Exchange hashpartitioning" in line for line in lines[:partial])


def test_manifest_entries_are_reduced_before_the_shuffle(without_broadcast):
    lines = plan(QUERIES["orphan_files"](without_broadcast, SF)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "ReadSchema: struct<l_orderkey:bigint>" in line)
    below = lines[:scan]
    exchange = max(i for i, line in enumerate(below) if "Exchange hashpartitioning" in line)
    assert any("HashAggregate" in line for line in below[exchange:])
