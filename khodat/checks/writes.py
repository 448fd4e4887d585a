"""Sinks and table writes, each read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from khodat.checks import data
from khodat.checks.registry import query
from khodat.operators import tables
from khodat.operators.files import write_csv, write_parquet
from khodat.operators.script import run_sql_script
from khodat.schema import Partition, TableSpec, struct
from khodat.session import scratch_database, scratch_path
from khodat.sources.files import read_csv
from khodat.sources.layers import BUSINESS_DATE

ORDERS = TableSpec(
    "orders",
    struct(o_orderkey="bigint", o_custkey="bigint", o_orderstatus="string", o_totalprice="double",
           o_orderdate="timestamp"),
    key_columns=("o_orderkey",),
)
ORDERS_SQL = (
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as timestamp) as o_orderdate from orders"
)


def orders(spark, sf):
    rows = data.table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return rows.select(*ORDERS.columns)


def changes(spark, sf):
    """New prices for all orders with line items, and one order more per customer."""
    priced = data.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_extendedprice").alias("o_totalprice")
    ).selectExpr("o_orderkey", "cast(null as bigint) as o_custkey", "'U' as o_orderstatus", "o_totalprice",
                 "timestamp '2024-12-09' as o_orderdate")
    added = data.table(spark, sf, "customer").selectExpr(
        "-1 - c_custkey as o_orderkey", "c_custkey as o_custkey", "'N' as o_orderstatus", "c_acctbal as o_totalprice",
        "timestamp '2024-12-09' as o_orderdate",
    )
    return priced.unionByName(added)


CHANGES_SQL = (
    "select l_orderkey as o_orderkey, cast(null as bigint) as o_custkey, 'U' as o_orderstatus, "
    "max(l_extendedprice) as o_totalprice, timestamp '2024-12-09' as o_orderdate from lineitem group by 1 "
    "union all select -1 - c_custkey, c_custkey, 'N', c_acctbal, timestamp '2024-12-09' from customer"
)
MERGED_SQL = (
    f"with t as ({ORDERS_SQL}), s as ({CHANGES_SQL}) select * from s union all "
    "select * from t where not exists (select 1 from s where s.o_orderkey = t.o_orderkey)"
)


@query("sink_parquet_append", f"{ORDERS_SQL} union all {ORDERS_SQL}")
def sink_parquet_append(spark, sf):
    path = scratch_path(spark, "orders")
    write_parquet(orders(spark, sf), path)
    write_parquet(orders(spark, sf), path)
    return spark.read.schema(ORDERS.schema).parquet(path)


@query(
    "sink_parquet_overwrite",
    "select l_orderkey, l_linenumber, l_extendedprice, case when l_returnflag = 'R' then l_quantity * 2 "
    "else l_quantity end as l_quantity, l_returnflag as business_date from lineitem",
)
def sink_parquet_overwrite(spark, sf):
    """A rerun of one partition replaces that partition only."""
    path = scratch_path(spark, "lines")
    lines = data.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", F.col("l_returnflag").alias(BUSINESS_DATE)
    )
    write_parquet(lines, path, overwrite=True, by=[BUSINESS_DATE])
    again = lines.where(F.col(BUSINESS_DATE) == "R").withColumn("l_quantity", F.col("l_quantity") * 2)
    write_parquet(again, path, overwrite=True, by=[BUSINESS_DATE])
    return spark.read.schema(lines.schema).parquet(path)


@query("sink_csv", f"select * replace (nullif(du_an, '') as du_an, nullif(location, '') as location) from ({data.LISTINGS_SQL}) l")
def sink_csv(spark, sf):
    path = scratch_path(spark, "listings.csv")
    rows = data.listings(spark, sf)
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@query(
    "create_table_if_not_exists",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(date_trunc('year', o_orderdate) as timestamp) "
    "as o_orderdate, cast(date_trunc('year', o_orderdate) as date) as o_orderdate_day, o_orderstatus as region "
    "from orders",
)
def create_table_if_not_exists(spark, sf):
    """Created twice: the second time nothing happens. Partitioned by a day and by a column the schema lacks."""
    name = f"{scratch_database(spark)}.orders"
    spec = TableSpec("orders", ORDERS.schema, (Partition("o_orderdate", "DAY"), Partition("region", "STRING")))
    tables.create_table(spark, name, spec, options={"compression": "snappy"})
    yearly = orders(spark, sf).withColumn("o_orderdate", F.date_trunc("year", "o_orderdate"))
    tables.insert_append(yearly.withColumn("region", F.col("o_orderstatus")), name)
    tables.create_table(spark, name, spec)
    return spark.table(name)


@query("create_or_replace_table_as", "select distinct l_orderkey, l_partkey, l_returnflag from lineitem")
def create_or_replace_table_as(spark, sf):
    name = f"{scratch_database(spark)}.lines"
    lines = data.table(spark, sf, "lineitem")
    tables.create_or_replace_table_as(lines.select("l_orderkey"), name)
    tables.create_or_replace_table_as(
        lines.select("l_orderkey", "l_partkey", "l_returnflag"), name, [Partition("l_returnflag")], ["l_orderkey"]
    )
    return spark.table(name)


@query(
    "sorted_table_write",
    "select l_returnflag, l_shipdate, l_orderkey from lineitem",
)
def sorted_table_write(spark, sf):
    name = f"{scratch_database(spark)}.lines"
    lines = data.table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_returnflag")
    tables.create_or_replace_table_as(
        lines, name, [Partition("l_returnflag")], ["l_shipdate", "l_orderkey"], distinct=False
    )
    return spark.table(name)


@query("insert_overwrite", "select distinct l_orderkey, l_suppkey from lineitem")
def insert_overwrite(spark, sf):
    name = f"{scratch_database(spark)}.pairs"
    lines = data.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey")
    tables.create_table(spark, name, TableSpec("pairs", struct(l_orderkey="bigint", l_suppkey="bigint")))
    tables.insert_append(lines, name)
    tables.insert_overwrite(lines, name, num_partitions=4)
    return spark.table(name)


@query("insert_append", f"select o_orderkey, o_totalprice from orders union all select o_orderkey, o_totalprice from orders")
def insert_append(spark, sf):
    name = f"{scratch_database(spark)}.prices"
    rows = data.table(spark, sf, "orders").select("o_totalprice", "o_orderkey")
    tables.create_table(spark, name, TableSpec("prices", struct(o_orderkey="bigint", o_totalprice="double")))
    tables.insert_append(rows, name)
    tables.insert_append(rows, name)
    return spark.table(name)


@query("merge_upsert", MERGED_SQL)
def merge_upsert(spark, sf):
    name = f"{scratch_database(spark)}.orders"
    orders(spark, sf).write.saveAsTable(name)
    tables.merge_into(changes(spark, sf), name, ORDERS.key_columns)
    return spark.table(name)


@query("write_disposition", f"select *, 1 as copy from ({MERGED_SQL}) m union all select *, 2 as copy from ({ORDERS_SQL}) o")
def write_disposition(spark, sf):
    """Empty, truncate and merge into one table, append to another."""
    db = scratch_database(spark)
    rows = orders(spark, sf)
    tables.write_table(rows, f"{db}.a", ORDERS, tables.WRITE_EMPTY)
    tables.write_table(rows, f"{db}.a", ORDERS, tables.WRITE_TRUNCATE, tables.CREATE_NEVER)
    tables.write_table(changes(spark, sf), f"{db}.a", ORDERS, tables.WRITE_MERGE)
    tables.write_table(rows, f"{db}.b", ORDERS, tables.WRITE_APPEND)
    return spark.table(f"{db}.a").withColumn("copy", F.lit(1)).unionByName(
        spark.table(f"{db}.b").withColumn("copy", F.lit(2))
    )


@query("drop_table", "select s_suppkey, s_name, false as old_exists from supplier")
def drop_table(spark, sf):
    db = scratch_database(spark)
    suppliers = data.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    suppliers.write.saveAsTable(f"{db}.old")
    suppliers.write.saveAsTable(f"{db}.kept")
    tables.drop_table(spark, f"{db}.old", purge=True)
    tables.drop_table(spark, f"{db}.old")
    return spark.table(f"{db}.kept").withColumn("old_exists", F.lit(spark.catalog.tableExists(f"{db}.old")))


@query(
    "retype_swap",
    f"select l_orderkey, l_linenumber, try_cast(created_date as timestamp) as created_date from ({data.TEXTS_SQL}) t",
)
def retype_swap(spark, sf):
    name = f"{scratch_database(spark)}.created"
    data.listing_texts(spark, sf).select("l_orderkey", "l_linenumber", "created_date").write.saveAsTable(name)
    tables.retype_swap(spark, name, {"created_date": "timestamp"})
    return spark.table(name)


SCRIPT = """
-- one line of comment, no statement;
CREATE TABLE IF NOT EXISTS IDENTIFIER(:target) (o_orderpriority STRING, n_orders BIGINT, top_price DOUBLE) USING parquet;

INSERT INTO IDENTIFIER(:target)
-- a comment before the rest of a statement
SELECT o_orderpriority, count(*), max(o_totalprice)
FROM IDENTIFIER(:source)
GROUP BY o_orderpriority;

SELECT *, :day AS business_date FROM IDENTIFIER(:target);
"""


@query(
    "run_sql_script",
    "select o_orderpriority, count(*) as n_orders, max(o_totalprice) as top_price, '20241209' as business_date "
    "from orders group by o_orderpriority",
)
def run_script(spark, sf):
    db = scratch_database(spark)
    data.table(spark, sf, "orders").write.saveAsTable(f"{db}.orders")
    params = {"source": f"{db}.orders", "target": f"{db}.priorities", "day": "20241209"}
    return run_sql_script(spark, SCRIPT, params)
