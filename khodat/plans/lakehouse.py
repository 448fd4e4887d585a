"""Source to raw, raw to staging, staging to warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from khodat.functions import parsing as P
from khodat.operators.columns import FLOOR_COLUMN, apply_schema, rename_columns
from khodat.operators.tables import (
    CREATE_IF_NEEDED, WRITE_APPEND, WRITE_TRUNCATE, create_database, create_table, drop_table, write_table,
)
from khodat.schema import LISTING_RAW, LISTING_STAGING, LISTING_WAREHOUSE, TableSpec
from khodat.sources.files import read_csv
from khodat.sources.layers import BUSINESS_DATE, layer_uri, read_business_date


def crawl_csv_schema(spec: TableSpec = LISTING_RAW) -> T.StructType:
    """The raw columns under their crawled names."""
    crawled, stored = FLOOR_COLUMN
    return T.StructType([T.StructField(crawled if f.name == stored else f.name, f.dataType, True) for f in spec.schema])


def source_load(spark: SparkSession, csv_path: str, multi_line: bool = False) -> DataFrame:
    """The crawl CSV as typed source rows, ready for any sink.

    A row is a line and large files are split; ``multi_line`` is for files whose fields hold line breaks.

    Missing values stay NULL throughout. Writing -1 for them and turning -1 back later would only lose
    genuine -1 values and leave '-1' in created_date.
    """
    return apply_schema(rename_columns(read_csv(spark, csv_path, crawl_csv_schema(), multi_line)), LISTING_RAW.schema)


def raw_extract(source: DataFrame, root: str, business_date: str, spec: TableSpec = LISTING_RAW) -> str:
    """Writes the source rows, cast to the declared schema, as the raw partition of one date; returns the folder.

    A rerun replaces that date only.
    """
    folder = layer_uri("raw", spec.name, root=root)
    rows = apply_schema(source.select(*spec.columns), spec.schema)
    # One constant partition value: nothing to bring together, so the rows are not shuffled.
    writer = rows.withColumn(BUSINESS_DATE, F.lit(business_date)).write.partitionBy(BUSINESS_DATE)
    writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(folder)
    return folder


def staging_rows(raw: DataFrame) -> DataFrame:
    """Distinct raw rows with created_date as a timestamp.

    Duplicates are judged on the text, before the cast, and the cast is part of the same write. Equal rows are brought
    together first, in parts of bounded size: files hold many times their bytes in rows, and a task that looked for
    copies in a whole split would hold all of it. Parts that one row fills are split, and collapse before the second shuffle.
    """
    columns = [F.col(c) for c in LISTING_RAW.columns]
    rows = raw.select(*columns).hint("rebalance", *columns).distinct()
    return rows.withColumn("created_date", P.cast_timestamp("created_date"))


def staging_load(spark: SparkSession, folder: str, business_date: str, table: str) -> None:
    """Rebuilds the staging table from one raw date."""
    raw = read_business_date(spark, folder, business_date, LISTING_RAW.schema)
    drop_table(spark, table)
    create_table(spark, table, LISTING_STAGING)
    write_table(staging_rows(raw), table, LISTING_STAGING, WRITE_TRUNCATE, distinct=False)


def warehouse_rows(staging: DataFrame) -> DataFrame:
    """Staging rows with the address split into ward and district, and the total price. No shuffle."""
    columns = [c for c in LISTING_WAREHOUSE.columns if c not in ("phuong", "quan", "created_date", "total")]
    return staging.select(
        *columns,
        P.extract_ward("location").alias("phuong"),
        P.extract_district("location").alias("quan"),
        "created_date",
        P.total_price("area", "price_m2").alias("total"),
    )


def warehouse_load(spark: SparkSession, staging: str, table: str, replace: bool = False) -> None:
    """Adds all staging rows to the warehouse table; every run adds them again unless ``replace`` is set."""
    write_table(
        warehouse_rows(spark.table(staging)), table, LISTING_WAREHOUSE,
        WRITE_TRUNCATE if replace else WRITE_APPEND, CREATE_IF_NEEDED, distinct=False,
    )


def end_to_end(
    spark: SparkSession,
    csv_path: str,
    root: str,
    business_date: str,
    staging: str,
    warehouse: str,
    multi_line: bool = False,
) -> None:
    """CSV to raw to staging to warehouse for one business date."""
    folder = raw_extract(source_load(spark, csv_path, multi_line), root, business_date)
    for table in (staging, warehouse):
        if "." in table:
            create_database(spark, table.rsplit(".", 1)[0])
    staging_load(spark, folder, business_date, staging)
    warehouse_load(spark, staging, warehouse)
