"""The composed loads."""

from __future__ import annotations

from khodat.checks import data
from khodat.checks.registry import query
from khodat.functions.parsing import cast_timestamp
from khodat.operators.files import write_csv
from khodat.operators.tables import write_table
from khodat.plans import ingest, lakehouse
from khodat.schema import LISTING_RAW, LISTING_STAGING
from khodat.session import scratch_database, scratch_path
from khodat.sources.layers import read_business_date

DATE = "20241209"
RAW_SQL = f"select * from ({data.LISTINGS_SQL}) l"
STAGING_SQL = (
    f"select * replace (try_cast(created_date as timestamp) as created_date) from (select distinct * from ({RAW_SQL}) r) d"
)


def crawl_csv(spark, sf) -> str:
    """The listings as the crawl leaves them: a CSV with the crawled column names. No text holds a line break."""
    path = scratch_path(spark, "crawl.csv")
    write_csv(data.listings(spark, sf).withColumnRenamed("So_tang", "Số tầng"), path)
    return path


@query("source_load", RAW_SQL)
def source_load(spark, sf):
    name = f"{scratch_database(spark)}.listing"
    rows = lakehouse.source_load(spark, crawl_csv(spark, sf))
    write_table(rows, name, LISTING_RAW, distinct=False)
    return spark.table(name)


@query("raw_extract", f"select *, '{DATE}' as business_date from ({RAW_SQL}) r")
def raw_extract(spark, sf):
    folder = lakehouse.raw_extract(data.listings(spark, sf), scratch_path(spark, "lake"), DATE)
    return read_business_date(spark, folder, DATE, LISTING_RAW.schema)


@query("staging_load", STAGING_SQL)
def staging_load(spark, sf):
    name = f"{scratch_database(spark)}.listing"
    folder = lakehouse.raw_extract(data.listings(spark, sf), scratch_path(spark, "lake"), DATE)
    lakehouse.staging_load(spark, folder, DATE, name)
    return spark.table(name)


@query("warehouse_transform", data.warehouse_sql(RAW_SQL))
def warehouse_transform(spark, sf):
    """Staging to warehouse, the flagship: no shuffle after the listings are read."""
    staging = data.listings(spark, sf).withColumn("created_date", cast_timestamp("created_date"))
    return lakehouse.warehouse_rows(staging)


@query("warehouse_load", f"{data.warehouse_sql(RAW_SQL)} union all {data.warehouse_sql(RAW_SQL)}")
def warehouse_load(spark, sf):
    """Two daily loads of one staging table: the warehouse holds its rows twice."""
    db = scratch_database(spark)
    staging = data.listings(spark, sf).withColumn("created_date", cast_timestamp("created_date"))
    write_table(staging, f"{db}.staging", LISTING_STAGING, distinct=False)
    lakehouse.warehouse_load(spark, f"{db}.staging", f"{db}.listing", replace=True)
    lakehouse.warehouse_load(spark, f"{db}.staging", f"{db}.listing")
    return spark.table(f"{db}.listing")


@query("listing_ingest", data.typed_sql(data.PAGE_TEXTS_SQL, floor="Số tầng", first="page_id, url, "))
def listing_ingest(spark, sf):
    pages = data.listing_pages(spark, sf)
    return ingest.listing_ingest(pages, data.index_pages(spark, sf))


@query("end_to_end", data.warehouse_sql(f"select distinct * from ({RAW_SQL}) r"))
def end_to_end(spark, sf):
    db = scratch_database(spark)
    lakehouse.end_to_end(
        spark, crawl_csv(spark, sf), scratch_path(spark, "lake"), DATE, f"{db}.listing_staging", f"{db}.listing",
    )
    return spark.table(f"{db}.listing")
