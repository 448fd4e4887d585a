"""File, layer, catalog and page scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from khodat.checks import data
from khodat.checks.registry import query
from khodat.operators import tables
from khodat.operators.files import write_csv, write_parquet
from khodat.schema import TableSpec, struct
from khodat.session import scratch_database, scratch_path
from khodat.sources import files, layers
from khodat.sources.html import Field, extract_fields, extract_links, listing_fields
from khodat.plans.ingest import listing_links

CUSTOMER = struct(c_custkey="bigint", c_name="string", c_nationkey="integer", c_acctbal="double", c_mktsegment="string")
RAW_ORDER = struct(o_orderkey="bigint", o_custkey="bigint", o_totalprice="double", o_orderpriority="string")


def raw_orders(spark, sf) -> str:
    """Orders as a raw table, one directory per quarter; returns its folder."""
    root = scratch_path(spark, "lake")
    folder = layers.layer_uri("raw", "orders", root=root)
    quarter = F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyyMMdd")
    orders = data.table(spark, sf, "orders").withColumn(layers.BUSINESS_DATE, quarter)
    write_parquet(orders.select(*RAW_ORDER.fieldNames(), layers.BUSINESS_DATE), folder, by=[layers.BUSINESS_DATE])
    return folder


ORDER_LIST = "o_orderkey, o_custkey, o_totalprice, o_orderpriority"
LOADED_SQL = "strftime(date_trunc('quarter', o_orderdate), '%Y%m%d')"


@query("scan_csv", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def scan_csv(spark, sf):
    path = scratch_path(spark, "customer.csv")
    write_csv(data.table(spark, sf, "customer"), path)
    return files.read_csv(spark, path, CUSTOMER)


@query(
    "scan_csv_line_breaks",
    "select o_orderkey, o_orderstatus || chr(10) || '\"' || o_orderpriority || chr(10) || '\",' as note, o_totalprice from orders",
)
def scan_csv_line_breaks(spark, sf):
    """One file whose quoted fields hold line breaks, quotes and commas; its splits are read by tasks of their own."""
    path = scratch_path(spark, "orders.csv")
    note = F.concat("o_orderstatus", F.lit('\n"'), "o_orderpriority", F.lit('\n",'))
    write_csv(data.table(spark, sf, "orders").select("o_orderkey", note.alias("note"), "o_totalprice").coalesce(1), path)
    return files.read_csv(spark, path, struct(o_orderkey="bigint", note="string", o_totalprice="double"), multi_line=True)


@query("scan_parquet_inferred", f"select {ORDER_LIST}, {LOADED_SQL} as business_date from orders")
def scan_parquet_inferred(spark, sf):
    folder = raw_orders(spark, sf)
    found = files.read_source(spark, folder)
    return found.withColumn("business_date", F.col("business_date").cast("string"))


@query("scan_parquet_empty_fallback", f"select {ORDER_LIST} from orders")
def scan_parquet_empty_fallback(spark, sf):
    """A date with files and one without any."""
    orders = data.table(spark, sf, "orders").select(*RAW_ORDER.fieldNames())
    filled, empty = scratch_path(spark, "filled"), scratch_path(spark, "empty")
    write_parquet(orders, filled)
    write_parquet(orders.where("o_orderkey is null"), empty, by=["o_orderpriority"])
    return files.read_source(spark, filled, schema=RAW_ORDER).unionByName(
        files.read_source(spark, empty, schema=RAW_ORDER)
    )


@query(
    "scan_with_options",
    "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer union all "
    "select o_custkey, o_orderpriority, cast(o_orderkey as integer), case when o_orderkey % 2 = 0 then o_totalprice end, 'order' from orders",
)
def scan_with_options(spark, sf):
    """Each format with options; the Parquet files differ in columns and types, and stray files lie beside them."""
    customers, orders = data.table(spark, sf, "customer"), data.table(spark, sf, "orders")
    as_json, as_csv, as_parquet = (scratch_path(spark, n) for n in ("json", "csv", "parquet"))
    customers.where("coalesce(c_acctbal < 0, false)").write.json(as_json)
    customers.where("not coalesce(c_acctbal < 0, false)").write.option("sep", "|").option("header", True).csv(as_csv)
    same = orders.selectExpr("o_custkey as c_custkey", "o_orderpriority as c_name", "o_orderkey as c_nationkey", "'order' as c_mktsegment", "o_totalprice")
    same.where("c_nationkey % 2 = 0").withColumnRenamed("o_totalprice", "c_acctbal").write.parquet(f"{as_parquet}/even")
    same.where("c_nationkey % 2 <> 0").drop("o_totalprice").write.parquet(f"{as_parquet}/odd")
    same.write.option("compression", "gzip").parquet(f"{as_parquet}/stray")
    options = {"mergeSchema": "true", "pathGlobFilter": "*.snappy.parquet", "recursiveFileLookup": "true"}
    return files.read_source(spark, as_json, "json", CUSTOMER, {"mode": "FAILFAST"}).unionByName(
        files.read_source(spark, as_csv, "csv", CUSTOMER, {"sep": "|", "header": "true"})
    ).unionByName(files.read_source(spark, as_parquet, "parquet", CUSTOMER, options))


@query(
    "scan_all_string",
    "select cast(s_suppkey as varchar) as s_suppkey, s_name, cast(s_nationkey as varchar) as s_nationkey, "
    "cast(s_acctbal as varchar) as s_acctbal from supplier",
)
def scan_all_string(spark, sf):
    path = scratch_path(spark, "supplier.csv")
    schema = struct(s_suppkey="bigint", s_name="string", s_nationkey="integer", s_acctbal="double")
    write_csv(data.table(spark, sf, "supplier"), path)
    return files.read_source(spark, path, "csv", schema, {"header": "true"}, all_string=True)


@query(
    "scan_partition_path",
    f"select {ORDER_LIST}, {LOADED_SQL} as business_date from orders where {LOADED_SQL} = '20010101'",
)
def scan_partition_path(spark, sf):
    return layers.read_business_date(spark, raw_orders(spark, sf), "20010101", RAW_ORDER)


@query("scan_glob_prefix", "select c_custkey, c_name from customer union all select s_suppkey, s_name from supplier")
def scan_glob_prefix(spark, sf):
    folder = scratch_path(spark, "dump")
    customers = data.table(spark, sf, "customer").selectExpr("c_custkey", "c_name")
    suppliers = data.table(spark, sf, "supplier").selectExpr("s_suppkey as c_custkey", "s_name as c_name")
    for n, part in enumerate((customers, suppliers)):
        part.write.option("compression", "gzip").json(f"{folder}/shop_party/party_{n}.json.gz")
    customers.write.json(f"{folder}/shop_party/other_0.json")
    uri = layers.file_set_uri(folder, "shop", "party", codec="gz")
    return files.read_source(spark, uri, "json", struct(c_custkey="bigint", c_name="string"))


@query("scan_catalog_table", "select o_orderkey, o_totalprice from orders")
def scan_catalog_table(spark, sf):
    name = f"{scratch_database(spark)}.orders"
    data.table(spark, sf, "orders").write.saveAsTable(name)
    return spark.table(name).select("o_orderkey", "o_totalprice")


@query("describe_schema", "select * from part")
def describe_schema(spark, sf):
    """A table created from the described columns of another one, then loaded from it."""
    db = scratch_database(spark)
    data.table(spark, sf, "part").write.partitionBy("p_brand").saveAsTable(f"{db}.source")
    described = files.describe_columns(spark, f"{db}.source")
    tables.create_table(spark, f"{db}.target", TableSpec("target", described))
    tables.insert_append(spark.table(f"{db}.source"), f"{db}.target")
    return spark.table(f"{db}.target")


@query("extract_html_field", data.PAGE_TEXTS_SQL)
def extract_html_field(spark, sf):
    return extract_fields(data.listing_pages(spark, sf), listing_fields())


def _plain_sql(pattern: str) -> str:
    """Text of an element with its entities resolved; a cut-off one may lack the semicolon."""
    text = f"regexp_extract(html, '{pattern}', 1)"
    for entity, plain in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#x27", "''"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{plain}', 'g')"
    return f"nfc_normalize({text})"


@query(
    "extract_html_field_pages",
    f"select page_id, {_plain_sql('<title>(.*?)</title>')} as title, {_plain_sql('<h1>(.*?)</h1>')} as heading from pages",
)
def extract_html_field_pages(spark, sf):
    fields = (Field("title", "title"), Field("heading", "h1"))
    return extract_fields(data.table(spark, sf, "pages").select("page_id", "html"), fields)


@query(
    "extract_html_links",
    f"select p_partkey // {data.LISTINGS_PER_INDEX} as page_id, p_partkey % {data.LISTINGS_PER_INDEX} as pos, "
    f"'/ban/' || p_partkey || '.htm' as href, {data.PAGE_URL_SQL} as link from part",
)
def extract_html_links(spark, sf):
    return listing_links(data.index_pages(spark, sf)).select("page_id", "pos", "href", "link")


@query(
    "extract_html_links_pages",
    "select page_id, generate_subscripts(links, 1) - 1 as pos, unnest(links) as href from (select page_id, "
    "list_filter(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), lambda x: x <> '' and not starts_with(x, 'https')) "
    "as links from pages) t",
)
def extract_html_links_pages(spark, sf):
    return extract_links(data.table(spark, sf, "pages").select("page_id", "html"), itemprop=None)
