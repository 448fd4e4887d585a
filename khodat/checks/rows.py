"""Counting, dedup, sizing, union, newest, snapshots, orphans."""

from __future__ import annotations

from pyspark.sql import functions as F

from khodat.checks import data
from khodat.checks.registry import query
from khodat.operators import maintenance, rows
from khodat.operators.files import write_parquet
from khodat.session import scratch_path
from khodat.sources.files import list_files


@query("count_rows", "select count(1) as n_rows from lineitem")
def count_rows(spark, sf):
    return rows.count_rows(data.table(spark, sf, "lineitem"))


@query("distinct_rows", "select distinct * from lineitem")
def distinct_rows(spark, sf):
    lines = data.table(spark, sf, "lineitem")
    return rows.distinct_rows(lines.unionByName(lines))


@query(
    "partition_count",
    "select count(*) as n_rows, greatest(cast(ceil(count(*) / 300000.0) as bigint), 1) as n_partitions from lineitem",
)
def partition_count(spark, sf):
    return rows.partition_count(data.table(spark, sf, "lineitem"))


@query(
    "union_pages",
    "select o_orderkey, o_totalprice, cast(null as varchar) as c_name from orders "
    "union all by name select c_name, c_acctbal as o_totalprice from customer",
)
def union_pages(spark, sf):
    orders = data.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    customers = data.table(spark, sf, "customer").select("c_name", F.col("c_acctbal").alias("o_totalprice"))
    return rows.union_by_name([orders, customers])


@query(
    "newest_file",
    "select o_custkey, o_orderkey as path, o_orderdate as mtime from (select *, row_number() over ("
    "partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) t where rn = 1",
)
def newest_file(spark, sf):
    files = data.table(spark, sf, "orders").selectExpr("o_custkey", "o_orderkey as path", "o_orderdate as mtime")
    return rows.newest(files, by=["o_custkey"])


@query(
    "expire_snapshots",
    'select "table", snapshot_id, committed_at from (select user_id as "table", event_id as snapshot_id, '
    "ts as committed_at, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t "
    "where rn > 2 and committed_at < timestamp '2024-01-20'",
)
def expire_snapshots(spark, sf):
    log = data.table(spark, sf, "events").selectExpr(
        "user_id as table", "event_id as snapshot_id", "ts as committed_at"
    )
    return maintenance.expired_snapshots(log, F.lit("2024-01-20").cast("timestamp_ntz"))


@query(
    "orphan_files",
    "select o_orderkey as path, o_orderdate as mtime from orders where o_orderdate < timestamp '2000-01-01' "
    "and not exists (select 1 from lineitem where l_orderkey = o_orderkey)",
)
def orphan_files(spark, sf):
    listing = data.table(spark, sf, "orders").selectExpr("o_orderkey as path", "o_orderdate as mtime")
    manifest = data.table(spark, sf, "lineitem").selectExpr("l_orderkey as path")
    return maintenance.orphan_files(listing, manifest, F.lit("2000-01-01").cast("timestamp_ntz"))


@query(
    "orphan_files_on_disk",
    "select 'Quận ' || c_mktsegment as segment, true as found from customer where c_custkey % 3 = 0 group by 1",
)
def orphan_files_on_disk(spark, sf):
    """A partitioned table under a folder with a space and partition values with Vietnamese letters; files that its manifest lacks."""
    folder = scratch_path(spark, "bảng khách hàng")
    customers = data.table(spark, sf, "customer").withColumn("segment", F.concat(F.lit("Quận "), "c_mktsegment"))
    write_parquet(customers, folder, by=["segment"])
    manifest_path = scratch_path(spark, "manifest")
    spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("path")).distinct().write.parquet(manifest_path)
    write_parquet(customers.where("c_custkey % 3 = 0"), folder, by=["segment"])
    found = maintenance.orphan_files(
        list_files(spark, folder).where("path like '%.parquet'"), spark.read.parquet(manifest_path), F.date_add(F.current_date(), 1)
    )
    segment = F.url_decode(F.regexp_extract("path", "segment=([^/]*)/", 1))
    return found.select(segment.alias("segment")).distinct().withColumn("found", F.lit(True))
