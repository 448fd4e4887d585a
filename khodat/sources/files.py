"""File scans with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from khodat.sources.layers import read_parquet
from khodat.sources.records import csv_records


# CSV texts that mean "missing", besides the empty field.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, missing: Sequence[str] = MISSING_TEXTS
) -> DataFrame:
    """Header CSV with the declared columns; the texts in ``missing`` are NULL, other bad values raise.

    Whole numbers may be written as 3.0, as they are when some are missing. Large files are read by many tasks. ``multi_line`` says
    that quoted fields may hold line breaks; then quotes are counted in a pass of its own, and lines are joined to records
    (``csv_records``). Without it a row is a line, and a field that holds a line break makes a row with the wrong number of fields,
    which raises.
    """
    parsing = {"mode": "FAILFAST", "escape": '"'}
    if multi_line:
        row = F.from_csv("record", as_strings(schema).simpleString(), {**parsing, "multiLine": "true"})
        rows = csv_records(spark, path).select(row.alias("row")).select("row.*")
    else:
        rows = spark.read.schema(as_strings(schema)).option("header", True).options(**parsing).csv(path)

    def one(field: T.StructField) -> Column:
        c = text = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            # Few texts end in 0, and a pattern costs more than the rest of the cast.
            text = F.when(c.endswith("0"), F.regexp_replace(c, r"\.0+$", "")).otherwise(c)
        if missing:
            text = F.when(~c.isin(*missing), text)
        return strict_cast(text, field.dataType).alias(field.name)

    return rows.select([one(f) for f in schema])


def strict_cast(c: Column, dtype: T.DataType) -> Column:
    """Cast that raises on bad values, even where the session has ANSI mode off."""
    if isinstance(dtype, T.StringType):
        return c.cast(dtype)
    message = F.concat(F.lit(f"cannot cast to {dtype.simpleString()}: "), c.cast("string"))
    # The check runs only where the cast gave nothing.
    return F.coalesce(c.try_cast(dtype), F.when(c.isNotNull(), F.raise_error(message).cast(dtype)))


def read_source(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
    all_string: bool = False,
) -> DataFrame:
    """Any file format with reader options.

    Parquet brings its own schema; declared columns are then taken from it by name and cast, strictly, to the declared
    types, and a column the files lack is NULL. Where there are no files at all the declared schema alone counts. Every
    other format needs the declared schema. ``all_string`` reads every declared column as text.
    """
    if fmt != "parquet" and (schema is None or not schema.fields):
        raise ValueError(f"a schema is required for {fmt} sources; only parquet brings its own")
    if fmt == "parquet":
        if schema is None:
            return read_parquet(spark, path, options=options)
        declared = as_strings(schema) if all_string else schema
        found = read_parquet(spark, path, declared, options)
        return found.select([_declared(found, f) for f in declared])
    if all_string:
        schema = as_strings(schema)
    return spark.read.format(fmt).options(**(options or {})).schema(schema).load(path)


def _declared(found: DataFrame, field: T.StructField) -> Column:
    """The column in its declared type. One that has it already stays a bare column, so filters on it reach the files."""
    own = next((f for f in found.schema if f.name.lower() == field.name.lower()), None)
    if own is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    c = F.col("`" + own.name.replace("`", "``") + "`")
    return (c if own.dataType == field.dataType else strict_cast(c, field.dataType)).alias(field.name)


def as_strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """path, mtime and size of every file below a directory; the contents are not read. The path is the URI that
    ``_metadata.file_path`` gives to rows of the file."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))
    )


def describe_columns(spark: SparkSession, table: str) -> T.StructType:
    """Column names and types of a catalog table, without the partition section DESCRIBE repeats."""
    rows = spark.sql(f"DESCRIBE TABLE {table}").collect()  # one row per column
    fields: dict[str, T.DataType] = {}
    for row in rows:
        if not row.col_name or row.col_name.startswith("#"):
            break
        fields[row.col_name] = T.DataType.fromDDL(row.data_type)
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])
