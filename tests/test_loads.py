"""The composed loads, from a crawl CSV to the warehouse."""

import datetime as dt

import pytest

from khodat.operators.files import write_csv
from khodat.plans import lakehouse
from khodat.schema import LISTING_RAW, LISTING_STAGING, LISTING_WAREHOUSE
from khodat.sources.layers import read_business_date

HEADER = "du_an string, price_VND double, location string, status string, area double, price_m2 double, " \
         "toilet double, room double, doc string, type string, `Số tầng` double, furnishing string, created_date string"
ROWS = [
    ("X", 5.2, "Phường A, Quận B, Hà Nội", "ok", 62.5, 83.2, 2.0, None, "sổ", "ch", 3.0, None, "2024-12-09 01:02:03.4"),
    ("X", 5.2, "Phường A, Quận B, Hà Nội", "ok", 62.5, 83.2, 2.0, None, "sổ", "ch", 3.0, None, "2024-12-09 01:02:03.4"),
    (None, None, "Xã C, Huyện D, Hà Nội", None, None, 10.0, None, 3.0, None, None, None, "đủ", "-1"),
    ("Y", -1.0, None, "ok", 10.0, 1.0, 1.0, 1.0, "a, \"b\"", "ch", 1.0, "đủ", None),
]


@pytest.fixture
def csv_path(spark, scratch):
    path = scratch("crawl.csv")
    write_csv(spark.createDataFrame(ROWS, HEADER), path)
    return path


def by_project(df):
    return {r.du_an: r for r in df.collect()}


def test_source_load(spark, csv_path):
    source = lakehouse.source_load(spark, csv_path)
    assert source.schema == LISTING_RAW.schema
    assert source.count() == 4
    rows = by_project(source)
    # The sentinel never appears, so a genuine -1 stays.
    assert rows["Y"].price_VND == -1.0 and rows["X"].So_tang == 3 and rows["X"].room is None
    assert rows[None].created_date == "-1"


def test_end_to_end_and_daily_append(spark, csv_path, scratch, database):
    root, staging, warehouse = scratch("lake"), f"{database}_s.listing", f"{database}_w.listing"
    lakehouse.end_to_end(spark, csv_path, root, "20241209", staging, warehouse)
    assert spark.table(staging).schema == LISTING_STAGING.schema
    assert spark.table(staging).count() == 3
    stored = spark.table(warehouse)
    assert stored.schema == LISTING_WAREHOUSE.schema
    rows = by_project(stored)
    assert (rows["X"].phuong, rows["X"].quan, rows["X"].total) == ("A", "B", 5.2)
    assert (rows[None].phuong, rows[None].quan, rows[None].total) == ("", "", None)
    assert rows["X"].created_date == dt.datetime(2024, 12, 9, 1, 2, 3, 400000)
    assert rows[None].created_date is None and rows["Y"].phuong is None

    lakehouse.end_to_end(spark, csv_path, root, "20241210", staging, warehouse)
    assert (spark.table(staging).count(), spark.table(warehouse).count()) == (3, 6)
    lakehouse.warehouse_load(spark, staging, warehouse, replace=True)
    assert spark.table(warehouse).count() == 3


def test_raw_rerun_replaces_one_date(spark, csv_path, scratch):
    root, source = scratch("lake"), lakehouse.source_load(spark, csv_path)
    for date in ("20241208", "20241209", "20241209"):
        folder = lakehouse.raw_extract(source, root, date)
    for date in ("20241208", "20241209"):
        assert read_business_date(spark, folder, date, LISTING_RAW.schema).count() == 4


def test_staging_judges_duplicates_before_the_cast(spark):
    raw = spark.createDataFrame(
        [tuple(None for _ in LISTING_RAW.columns[:-1]) + (t,) for t in ("2024-12-09", "2024-12-09 00:00:00", "2024-12-09")],
        LISTING_RAW.schema,
    )
    assert lakehouse.staging_rows(raw).count() == 2


def test_the_warehouse_transform_does_not_shuffle(spark, csv_path):
    source = lakehouse.source_load(spark, csv_path)
    plan = lakehouse.warehouse_rows(source)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_staging_shuffles_once(spark, csv_path):
    plan = lakehouse.staging_rows(lakehouse.source_load(spark, csv_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_staging_brings_equal_rows_together_before_it_looks_for_copies(spark, csv_path):
    text = lakehouse.staging_rows(lakehouse.source_load(spark, csv_path))._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in text.splitlines() if "HashAggregate" in line or "REBALANCE_PARTITIONS_BY_COL" in line]
    assert "REBALANCE_PARTITIONS_BY_COL" in lines[-1]
