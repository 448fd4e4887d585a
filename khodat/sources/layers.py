"""Where tables of the raw, staging and warehouse layers live, and reading one business date."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUSINESS_DATE = "business_date"


def layer_uri(
    layer: str,
    table: str,
    partition: str | None = None,
    prefix: str | None = None,
    fmt: str | None = None,
    root: str | None = None,
) -> str:
    """``root/layer/table[/partition][/prefix_][*.fmt]``."""
    folder = "/".join(p for p in (root.rstrip("/") if root else None, layer, table, partition) if p)
    if prefix:
        return f"{folder}/{prefix}_" + (f"*.{fmt}" if fmt else "")
    return f"{folder}/*.{fmt}" if fmt else folder


def file_set_uri(folder: str, source: str, table: str, fmt: str = "json", codec: str | None = None) -> str:
    """Glob over the numbered files of a table, ``folder/source_table/table_*``, with an optional codec suffix.

    The codec stands before ``.parquet`` but after ``.json``.
    """
    suffix = f".{codec}" if codec else ""
    ending = f"{suffix}.parquet" if fmt == "parquet" else f".{fmt}{suffix}"
    return f"{folder}/{source}_{table}/{table}_*{ending}"


def read_business_date(
    spark: SparkSession, folder: str, date: str, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of one ``business_date=`` directory; no other is listed, however many there are.

    The partition value is always text, so 20010102 does not turn into a number. A date that is not there gives no
    rows if a schema is declared, else it raises.
    """
    path = f"{folder.rstrip('/')}/{BUSINESS_DATE}={_escaped(date)}"
    if schema is None:
        schema = spark.read.parquet(path).schema
    with_date = T.StructType([f for f in schema if f.name != BUSINESS_DATE] + [T.StructField(BUSINESS_DATE, T.StringType(), True)])
    try:
        return spark.read.schema(with_date).option("basePath", folder).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], with_date)


def _escaped(value: str) -> str:
    """A partition value as directory names have it: control characters and those with a meaning in paths as %XX."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED_IN_PATHS or ord(c) < 32 or ord(c) == 127 else c for c in value)


# Characters that names of partition directories escape.
ESCAPED_IN_PATHS = "\"#%'*/:=?\\{[]^"


def partition_date_filter(dates: list[str], year: str = "year", month: str = "month", day: str = "day") -> Column:
    """Condition on the partition columns that holds for the given yyyymmdd dates: one set test, however many there are."""
    if not dates:
        return F.lit(False)
    days = ", ".join(str(int(d[:4]) * 10000 + int(d[4:6]) * 100 + int(d[6:])) for d in dates)
    y, m, d = (f"int(`{c}`)" for c in (year, month, day))
    return F.expr(f"{y} * 10000 + {m} * 100 + {d} IN ({days})")


def read_parquet(
    spark: SparkSession, path: str, fallback: T.StructType | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """Parquet with the schema found in the files, and reader options.

    A directory without any files gives an empty frame with the ``fallback`` schema. Only that case is
    caught: unreadable files or a missing directory still raise.
    """
    reader = spark.read.options(**(options or {}))
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if fallback is None or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return reader.schema(fallback).parquet(path)
