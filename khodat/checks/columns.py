"""Projections, filters and casts."""

from __future__ import annotations

from pyspark.sql import functions as F

from khodat.checks import data
from khodat.checks.registry import query
from khodat.operators import columns as C
from khodat.operators.files import write_parquet
from khodat.schema import struct
from khodat.session import scratch_path
from khodat.sources.layers import partition_date_filter

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ETL_DATE = "2024-12-09 01:02:03"
AUDIT_SQL = f"timestamp '{ETL_DATE}' as \"ETL_DATE\", '20241209' as \"BUSINESS_DATE\""


def _etl_date():
    return F.lit(ETL_DATE).cast("timestamp")


@query("select_columns", "select o_orderkey, o_custkey, o_totalprice * 2 as twice from orders")
def select_columns(spark, sf):
    return C.select_columns(data.table(spark, sf, "orders"), ["o_orderkey", "`o_custkey`", "o_totalprice * 2 AS twice"])


@query("audit_columns", f"select {AUDIT_SQL}, o_orderkey, o_totalprice from orders")
def audit_columns(spark, sf):
    return C.extract(data.table(spark, sf, "orders"), "20241209", ["o_orderkey", "o_totalprice"], etl_date=_etl_date())


@query("extract_with_filter", f"select {AUDIT_SQL}, o_orderkey from orders where o_totalprice > 250000")
def extract_with_filter(spark, sf):
    return C.extract(
        data.table(spark, sf, "orders"), "20241209", ["o_orderkey"], where="o_totalprice > 250000", etl_date=_etl_date()
    )


@query(
    "extract_with_server_key",
    f"select {AUDIT_SQL}, o_orderkey, o_orderstatus || '-' || o_orderpriority as \"ServerKey\" from orders",
)
def extract_with_server_key(spark, sf):
    orders = data.table(spark, sf, "orders").withColumn("ServerKey", F.lit("old"))
    key = F.concat_ws("-", "o_orderstatus", "o_orderpriority")
    return C.extract(orders, "20241209", ["o_orderkey", '"ServerKey"'], etl_date=_etl_date(), server_key=key)


@query("date_filter", "select event_id, ts from events where strftime(ts, '%Y-%m-%d') > '2024-01-10'")
def date_filter(spark, sf):
    return data.table(spark, sf, "events").where(C.date_filter("ts", ">", "2024-01-10")).select("event_id", "ts")


@query(
    "partition_date_filter",
    "select o_orderkey, year(o_orderdate) as year, month(o_orderdate) as month, 1 as day from orders "
    "where strftime(o_orderdate, '%Y%m') in ('199602', '199712', '200001')",
)
def partition_date_filter_query(spark, sf):
    orders = data.table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.lit(1).alias("day")
    )
    path = scratch_path(spark, "orders_by_day")
    write_parquet(orders, path, by=["year", "month", "day"])
    stored = spark.read.schema("o_orderkey bigint, year int, month int, day int").parquet(path)
    return stored.where(partition_date_filter(["19960201", "19971201", "20000101"]))


@query(
    "rename_column",
    f"select location, try_cast(trim(floor) as bigint) as \"So_tang\" from ({data.TEXTS_SQL}) t",
)
def rename_column(spark, sf):
    crawled = data.normalize_listing(data.listing_texts(spark, sf)).select("location", "Số tầng")
    return C.rename_columns(crawled)


@query(
    "apply_schema",
    "select o_orderkey, o_totalprice, cast(o_orderdate as timestamp) as o_orderdate, o_orderpriority, "
    "try_cast(o_orderstatus as bigint) as o_orderstatus from orders",
)
def apply_schema(spark, sf):
    orders = data.table(spark, sf, "orders")
    texts = orders.select([F.col(c).cast("string").alias(c) for c in orders.columns])
    strict = C.apply_schema(
        texts, struct(o_orderkey="bigint", o_totalprice="double", o_orderdate="timestamp", o_orderpriority="string",
                      o_orderstatus="string"),
    )
    return C.apply_schema(
        strict, struct(o_orderkey="bigint", o_totalprice="double", o_orderdate="timestamp", o_orderpriority="string",
                       o_orderstatus="bigint"), strict=False,
    )


@query(
    "staging_type_relax",
    "select o_orderkey, cast(cast(o_totalprice as decimal(18, 2)) as varchar) as price, "
    "cast(cast(o_orderdate as date) as varchar) as day from orders",
)
def staging_type_relax(spark, sf):
    return C.relax_types(data.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(o_totalprice as decimal(18, 2)) as price", "cast(o_orderdate as date) as day"
    ))


@query(
    "export_type_widen",
    "select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, cast(cast(l_tax as float) as double) as tax, "
    "l_quantity, cast(cast(l_extendedprice as decimal(38, 6)) as varchar) as price from lineitem",
)
def export_type_widen(spark, sf):
    wide = C.widen_types(data.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_tax as float) as tax", "l_quantity",
        "cast(l_extendedprice as decimal(38, 6)) as price",
    ))
    return wide.withColumn("price", F.col("price").cast("string"))


@query("drop_string_columns", "select c_custkey, c_nationkey, c_acctbal from customer")
def drop_string_columns(spark, sf):
    return C.drop_string_columns(data.table(spark, sf, "customer"))
