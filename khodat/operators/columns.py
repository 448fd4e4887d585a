"""Projections, audit columns, date filters and casts to declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from khodat.sources.files import strict_cast

FLOOR_COLUMN = ("Số tầng", "So_tang")  # crawled name, table name


def quoted(name: str) -> str:
    """Back-quoted column name; a name that starts with a back-quote or holds a space is an expression."""
    return name if name.startswith("`") or " " in name else f"`{name}`"


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.selectExpr(*[quoted(c) for c in columns])


def with_audit_columns(
    df: DataFrame, business_date: str, etl_date: Column | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """ETL_DATE (now, or the given expression) and BUSINESS_DATE in front of the columns."""
    stamp = F.current_timestamp() if etl_date is None else etl_date
    names = df.columns if columns is None else columns
    return df.select(
        stamp.alias("ETL_DATE"), F.lit(business_date).alias("BUSINESS_DATE"), *[F.col(f"`{c}`") for c in names]
    )


def extract(
    df: DataFrame,
    business_date: str,
    columns: Sequence[str],
    where: str | Column | None = None,
    etl_date: Column | None = None,
    server_key: Column | None = None,
) -> DataFrame:
    """Audit columns plus the given ones, filtered first; ``server_key`` replaces the column ServerKey."""
    rows = df if where is None else df.where(where)
    names = list(columns)
    if server_key is not None:
        names = [c for c in names if c.strip('"') != "ServerKey"]
        rows = rows.withColumn("ServerKey", server_key)
        names.append("ServerKey")
    return with_audit_columns(rows, business_date, etl_date, names)


_COMPARE = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def date_filter(column: str | Column, operator: str, date: str) -> Column:
    """Compares the day of a column with a yyyy-mm-dd date, whatever the time of day.

    Written as bounds on the column itself, not on a value computed from it, so that readers can skip files.
    """
    c = F.col(column) if isinstance(column, str) else column
    start = F.to_timestamp_ntz(F.lit(date))
    end = start + F.expr("interval 1 day")
    if operator == "=":
        return (c >= start) & (c < end)
    if operator in ("!=", "<>"):
        return (c < start) | (c >= end)
    if operator in ("<", ">="):
        return _COMPARE[operator](c, start)
    if operator in ("<=", ">"):
        return _COMPARE["<" if operator == "<=" else ">="](c, end)
    raise ValueError(f"unknown operator {operator!r}; one of {sorted(_COMPARE)}")


def rename_columns(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed(dict([FLOOR_COLUMN]) if names is None else names)


def apply_schema(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """The schema's columns, cast to its types. Bad values raise, or become NULL when not ``strict``."""

    def one(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if df.schema[field.name].dataType == field.dataType:
            return c
        return (strict_cast(c, field.dataType) if strict else c.try_cast(field.dataType)).alias(field.name)

    return df.select([one(f) for f in schema])


def relax_types(df: DataFrame) -> DataFrame:
    """Decimals and dates as text, everything else as it is."""
    return df.select([
        F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, (T.DecimalType, T.DateType))
        else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def widen_types(df: DataFrame) -> DataFrame:
    """Types of the export: int to bigint, float to double; decimal(38, 6..9) and the others stay."""
    wider = {T.IntegerType(): "bigint", T.FloatType(): "double"}
    return df.select([
        F.col(f"`{f.name}`").cast(wider[f.dataType]).alias(f.name) if f.dataType in wider else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def drop_string_columns(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.StringType)])
