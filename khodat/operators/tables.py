"""Catalog tables: create, replace, overwrite, append, merge, retype, drop."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from khodat.functions.dates import DAY_SUFFIX, day_partition
from khodat.operators import swap
from khodat.operators.merge import merge_upsert, quoted, same_keys
from khodat.operators.rows import ranged_for_write, sized_for_write
from khodat.schema import DEFAULT_TABLE_PROPERTIES, FILE_FORMATS, ROW_LEVEL_FORMATS, Partition, TableSpec
from khodat.session import scratch_database
from khodat.sources.files import as_strings

WRITE_TRUNCATE, WRITE_APPEND, WRITE_EMPTY, WRITE_MERGE, WRITE_REPLACE = (
    "WRITE_TRUNCATE", "WRITE_APPEND", "WRITE_EMPTY", "WRITE_MERGE", "WRITE_REPLACE",
)
CREATE_IF_NEEDED, CREATE_NEVER = "CREATE_IF_NEEDED", "CREATE_NEVER"


def _text(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pairs(values: dict[str, str]) -> str:
    return ", ".join(f"{_text(k)}={_text(v)}" for k, v in values.items())


def _detail(spark: SparkSession, table: str) -> dict[str, str]:
    """What DESCRIBE says of the table besides its columns."""
    rows = [(r.col_name, r.data_type) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    start = next((i for i, (name, _) in enumerate(rows) if name.startswith("# Detailed")), len(rows))
    return dict(rows[start + 1 :])


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(
    spark: SparkSession,
    table: str,
    spec: TableSpec,
    fmt: str | None = None,
    location: str | None = None,
    options: dict[str, str] | None = None,
    all_string: bool = False,
) -> None:
    """Creates the table unless it exists: columns, partitions, options, properties, location.

    A DAY partition is a transform where the format has them, else a date column of its own, derived on write.
    A partition column the schema lacks is added with the type its kind implies.
    """
    fmt = fmt or spec.format
    schema = as_strings(spec.schema) if all_string else spec.schema
    added, partition_by = [], []
    for p in spec.partitions:
        if p.kind == "NONE":
            continue
        if p.kind == "DAY" and fmt == "iceberg":
            partition_by.append(f"days(`{p.column}`)")
            continue
        name = f"{p.column}{DAY_SUFFIX}" if p.kind == "DAY" else p.column
        if name not in schema.fieldNames():
            added.append(T.StructField(name, T.StringType() if all_string else _KIND_TYPES[p.kind], True))
        partition_by.append(f"`{name}`")
    columns = T.StructType(schema.fields + added)
    clauses = [f"CREATE TABLE IF NOT EXISTS {table} ({columns.toDDL()}) USING {fmt}"]
    if options:
        clauses.append(f"OPTIONS ({_pairs(options)})")
    if partition_by:
        clauses.append("PARTITIONED BY (" + ", ".join(partition_by) + ")")
    if location:
        clauses.append(f"LOCATION {_text(location)}")
    clauses.append(f"TBLPROPERTIES ({_pairs(spec.table_properties())})")
    spark.sql("\n".join(clauses))


_KIND_TYPES = {
    "DAY": T.DateType(), "INTEGER": T.IntegerType(), "NUMERIC": T.DecimalType(38, 9),
    "STRING": T.StringType(), "BOOLEAN": T.BooleanType(),
}


def with_partitions(df: DataFrame, partitions: Sequence[Partition]) -> tuple[DataFrame, list[str]]:
    names = []
    for p in partitions:
        df, name = day_partition(df, p)
        if name:
            names.append(name)
    return df, names


def create_or_replace_table_as(
    df: DataFrame,
    table: str,
    partitions: Sequence[Partition] = (),
    sort_by: Sequence[str] = (),
    distinct: bool = True,
    num_partitions: int | None = None,
    fmt: str = "parquet",
    location: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Replaces the table, schema included, by the rows of ``df``; partitioned tables need a sort order.

    Files hold ranges of partition and sort columns that do not overlap, and are sorted, so that a filter on them leaves most files
    unread. A DAY partition is a
    transform where the format has them. A table that exists keeps its properties and, unless another is given, a location
    outside of the warehouse; given properties win over those, and those over the defaults.
    """
    spark = df.sparkSession
    if partitions and not sort_by:
        raise ValueError("a partitioned table needs sort columns")
    before: dict[str, str] = {}
    if spark.catalog.tableExists(table):
        before, detail = _properties(spark, table), _detail(spark, table)
        location = location or (detail.get("Location") if detail.get("Type") == "EXTERNAL" else None)
    rows = df.distinct() if distinct else df
    all_properties = {**DEFAULT_TABLE_PROPERTIES, **before, **(properties or {})}
    if fmt in ROW_LEVEL_FORMATS:
        by = [F.days(p.column) if p.kind == "DAY" else F.col(quoted(p.column)) for p in partitions if p.kind != "NONE"]
        writer = (ranged_for_write(rows, sort_by, num_partitions) if sort_by else rows).writeTo(table).using(fmt)
        for key, value in {**all_properties, **({"location": location} if location else {})}.items():
            writer = writer.tableProperty(key, value)
        (writer.partitionedBy(*by) if by else writer).createOrReplace()
        return
    rows, names = with_partitions(rows, partitions)
    rows = ranged_for_write(rows, [*names, *sort_by], num_partitions) if sort_by else sized_for_write(rows, num_partitions, names)
    writer = rows.write.format(fmt).mode("overwrite")
    if location:
        writer = writer.option("path", location)
    (writer.partitionBy(*names) if names else writer).saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_pairs(all_properties)})")


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    """Columns by name in the order of the table; partition days are derived from their timestamps."""
    spark = df.sparkSession
    missing = [c for c in _partition_columns(spark, table) if c not in df.columns and c.endswith(DAY_SUFFIX)]
    days = {c: F.to_date(quoted(c.removesuffix(DAY_SUFFIX))) for c in missing}
    return df.withColumns(days).select(*map(quoted, spark.table(table).columns))


def _sized_for_table(
    df: DataFrame, table: str, num_partitions: int | None = None, sort_by: Sequence[str] = ()
) -> DataFrame:
    rows = _in_table_order(df, table)
    names = _partition_columns(df.sparkSession, table)
    return ranged_for_write(rows, [*names, *sort_by], num_partitions) if sort_by else sized_for_write(rows, num_partitions, names)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session setting has this value meanwhile."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _overwriting(spark: SparkSession, mode: str):
    """What an overwrite replaces meanwhile: the ``static`` whole table, or the ``dynamic`` partitions that get rows. An
    insert into a table takes that from the session alone."""
    return _setting(spark, "spark.sql.sources.partitionOverwriteMode", mode)


# Shuffled bytes, compressed, that one task of a merge is meant to get.
MERGE_TASK_BYTES = 8 * 1024 * 1024


def _small_tasks(spark: SparkSession):
    """Shuffles are merged and split to MERGE_TASK_BYTES meanwhile. Rows of a few numbers take ten times their shuffled
    bytes and more in sorts and hash tables, so tasks of the usual size would need gigabytes. For steps whose files are not the
    table's: those would get small as well."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    return _setting(spark, key, f"{min(usual, MERGE_TASK_BYTES)}b")


def insert_overwrite(
    df: DataFrame, table: str, distinct: bool = True, num_partitions: int | None = None, sort_by: Sequence[str] = (),
    files: Sequence[str] | None = None,
) -> None:
    """Replaces all rows of the table, or those of its ``files`` (as ``_metadata.file_path`` names them), whatever the session's
    overwrite mode; no setting is touched.

    A plain file table gets the new files beside the old ones, hidden, and they are swapped under a journal (``swap``): a failure
    until then changes nothing, a later one is made good by ``recover_table`` or the next write. Formats with
    row-level writes do it in their own way. Until its files are swapped ``df`` may read from the table itself.
    """
    spark = df.sparkSession
    rows = df.distinct() if distinct else df
    if _detail(spark, table).get("Provider", "").lower() not in FILE_FORMATS:
        with _overwriting(spark, "static"):
            _sized_for_table(rows, table, num_partitions, sort_by).write.insertInto(table, overwrite=True)
        return
    recover_table(spark, table)
    place = _place(spark, table)
    hidden = swap.begin()
    database = scratch_database(spark)
    try:
        # Like the table in all that its files depend on.
        spark.sql(f"CREATE TABLE {database}.next LIKE {table} LOCATION {_text(place.at(hidden).toString())}")
        _sized_for_table(rows, table, num_partitions, sort_by).write.insertInto(f"{database}.next")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    place.fs.mkdirs(place.at(hidden))
    swap.record(place, hidden, place.names() if files is None else map(place.relative, files))
    changed = swap.finish(place, hidden)
    # A table that was made anew at an old place knows none of its folders.
    _swapped(spark, table, changed or files is None)


def _place(spark: SparkSession, table: str) -> swap.Place:
    return swap.Place(spark, _detail(spark, table)["Location"])


def _swapped(spark: SparkSession, table: str, folders_changed: bool) -> None:
    if folders_changed and _partition_columns(spark, table):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")


def recover_table(spark: SparkSession, table: str) -> None:
    """After a failed write: the table is as it was before, or as the write would have left it."""
    if _detail(spark, table).get("Provider", "").lower() in FILE_FORMATS and swap.recover(_place(spark, table)):
        _swapped(spark, table, True)


def insert_append(df: DataFrame, table: str, sort_by: Sequence[str] = ()) -> None:
    """Adds the rows; running it twice adds them twice."""
    _sized_for_table(df, table, sort_by=sort_by).write.insertInto(table)


@contextmanager
def _staged(df: DataFrame) -> Iterator[str]:
    """A table in the shared folder that holds the rows of ``df``. It goes afterwards, but stays if the work with it fails:
    by then it may be the only place of the rows."""
    spark = df.sparkSession
    database = scratch_database(spark)
    table = f"{database}.staged"
    with _small_tasks(spark):
        df.write.saveAsTable(table)
    try:
        yield table
    except Exception as error:
        error.add_note(f"the new rows are kept in the table {table}")
        raise
    spark.sql(f"DROP DATABASE {database} CASCADE")


def _keepable(spark: SparkSession, table: str) -> str:
    """The table's format, if its content can be replaced so that the table stays what it is."""
    provider = _detail(spark, table).get("Provider", "").lower()
    if provider not in FILE_FORMATS + ROW_LEVEL_FORMATS:
        raise ValueError(f"{table} is stored as {provider or 'nothing known'}; its rows can't be replaced in place")
    return provider


def replace_content(df: DataFrame, table: str) -> None:
    """Replaces the rows of the table by ``df``, which may read from it and has the table's columns.

    Format, options, location, comments, properties and partitions stay: the table itself is never dropped. The result
    is stored first; a failure until then changes nothing.
    """
    _keepable(df.sparkSession, table)
    with _staged(df) as staged:
        insert_overwrite(df.sparkSession.table(staged), table, distinct=False)


def _column_list(df: DataFrame, like: DataFrame) -> str:
    comments = {f.name: f.metadata.get("comment") for f in like.schema}
    return ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}" + (f" COMMENT {_text(comments[f.name])}" if comments.get(f.name) else "")
        for f in df.schema
    )


def replace_with_types(df: DataFrame, table: str) -> None:
    """Replaces rows and column types of the table by those of ``df``; everything else stays.

    Plain file tables can't change a type, so there the table is made anew from its own definition, at its old location if it
    has one of its own, while the one before stands aside under another name and comes back if the new one can't be made or
    filled: its files are not touched until the new ones are complete. Formats with row-level writes replace the
    table in one step of their own.
    """
    spark = df.sparkSession
    provider = _keepable(spark, table)
    columns = _column_list(df, spark.table(table))
    # From the format on: options, partitions, comment, location, properties.
    definition = "USING " + spark.sql(f"SHOW CREATE TABLE {table}").first()[0].split("\nUSING ", 1)[1]
    with _staged(df) as staged:
        if provider in ROW_LEVEL_FORMATS:
            spark.sql(f"CREATE OR REPLACE TABLE {table}\n{definition}\nAS SELECT * FROM {staged}")
            return
        before = f"{table}__before"
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
        try:
            spark.sql(f"CREATE TABLE {table} ({columns})\n{definition}")
            insert_overwrite(spark.table(staged), table, distinct=False)
        except Exception as error:
            if spark.catalog.tableExists(table) and swap.has_journal(_place(spark, table)):
                error.add_note(f"the new files of {table} are complete: recover_table puts them in place, then {before} can be dropped")
                raise
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.sql(f"ALTER TABLE {before} RENAME TO {table}")
            raise
        spark.sql(f"DROP TABLE {before}")


# A source is broadcast in a merge if its values take at most this many bytes.
SMALL_SOURCE_BYTES = 64 * 1024 * 1024


def is_small(source: DataFrame) -> bool:
    """Whether the frame is small enough to broadcast, measured value by value: files can hold far more than their size
    when values repeat."""
    row_bytes = reduce(add, [F.coalesce(F.octet_length(F.col(quoted(c)).cast("string")), F.lit(0)) + 16 for c in source.columns])
    return (source.agg(F.sum(row_bytes.cast("bigint"))).first()[0] or 0) <= SMALL_SOURCE_BYTES


def has_merge(spark: SparkSession, table: str) -> bool:
    """Whether the table's format has a MERGE of its own."""
    return _detail(spark, table).get("Provider", "").lower() in ROW_LEVEL_FORMATS


def _in_partitions(names: Sequence[str], values: Sequence[str]):
    """Condition on partition columns alone, so that the others are not even listed. One set test, however many values."""
    return _partition_key(names).isin(list(values))


def _partition_key(names: Sequence[str]):
    return F.to_json(F.struct(*map(quoted, names)), {"ignoreNullFields": "false"})


def _merge_partitions(source: DataFrame, table: str, keys: Sequence[str], names: Sequence[str], small: bool) -> None:
    """A merge that rewrites only the partitions it touches: those of matched rows, before and after, and of added rows.

    Their names come to the driver, as they do for every listing of the table.
    """
    spark = source.sparkSession
    target = spark.table(table)
    wanted = F.broadcast(source) if small else source
    matched = target.alias("t").join(wanted.select(*map(quoted, keys)).alias("s"), same_keys(keys, "t", "s"), "left_semi")
    key = _partition_key(names).alias("partition")
    with _small_tasks(spark):
        touched = matched.select(key, *map(quoted, names)).unionByName(source.select(key, *map(quoted, names))).distinct().collect()
        if not touched:
            return
        within = target.where(_in_partitions(names, [r.partition for r in touched]))
        merged = merge_upsert(within, source, keys, dedup=False, small_source=small)
    _replace_files(merged, table, _files_of(within))


def _files_of(rows: DataFrame) -> list[str]:
    """The files that hold the rows. Their names come to the driver, as they do for every listing of a table."""
    return [r.path for r in rows.select(F.col("_metadata.file_path").alias("path")).distinct().collect()]


def _replace_files(rows: DataFrame, table: str, files: Sequence[str]) -> None:
    """Puts ``rows``, which may read from the table, in place of the ``files``. They are stored first."""
    with _staged(rows) as staged:
        insert_overwrite(rows.sparkSession.table(staged), table, distinct=False, files=files)


def _merge_files(source: DataFrame, table: str, keys: Sequence[str], small: bool) -> None:
    """A merge that rewrites only the files that hold a matched row. Just keys are read to find them."""
    spark = source.sparkSession
    target = spark.table(table)
    wanted = F.broadcast(source) if small else source
    path = F.col("_metadata.file_path")
    matched = target.select(*map(quoted, keys), path.alias("_file")).alias("t").join(
        wanted.select(*map(quoted, keys)).alias("s"), same_keys(keys, "t", "s"), "left_semi",
    )
    with _small_tasks(spark):
        files = [r._file for r in matched.select("_file").distinct().collect()]
        if not files and source.isEmpty():
            return
        # Every row with a key of the source is in one of these files.
        within = target.where(path.isin(files))
        merged = merge_upsert(within, source, keys, dedup=False, small_source=small)
    _replace_files(merged, table, files)


def merge_into(df: DataFrame, table: str, keys: Sequence[str], distinct: bool = True) -> None:
    """Updates the rows whose keys match and adds the others.

    Where the table format has MERGE that is used, and only the files with matches are rewritten. Plain file tables have
    none: there the partitions that change are rewritten, or the files with matches if it has no partitions, and swapped under a
    journal. The source then goes to the shared folder first, since it is read several times. A small one is broadcast, so the target is not
    shuffled; beyond that both sides are shuffled by key.
    """
    spark = df.sparkSession
    rows = _in_table_order(df, table)
    rows = rows.distinct() if distinct else rows
    if not keys:
        raise ValueError("a merge needs key columns")
    if has_merge(spark, table):
        rows.alias("s").mergeInto(table, same_keys(keys, table, "s")).whenMatched().updateAll().whenNotMatched().insertAll().merge()
        return
    if _keepable(spark, table) in FILE_FORMATS:
        recover_table(spark, table)
    with _staged(rows) as staged:
        source = spark.table(staged)
        small, names = is_small(source), _partition_columns(spark, table)
        if names:
            _merge_partitions(source, table, keys, names, small)
        else:
            _merge_files(source, table, keys, small)


def retype_swap(spark: SparkSession, table: str, types: dict[str, str]) -> None:
    """Changes column types; a value that cannot be read in the new type becomes NULL."""
    df = spark.table(table)
    retyped = [F.col(quoted(c)).try_cast(types[c]).alias(c) if c in types else F.col(quoted(c)) for c in df.columns]
    replace_with_types(df.select(*retyped), table)


def drop_table(spark: SparkSession, table: str, purge: bool = False) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}{' PURGE' if purge else ''}")


def write_table(
    df: DataFrame,
    table: str,
    spec: TableSpec,
    write: str = WRITE_TRUNCATE,
    create: str = CREATE_IF_NEEDED,
    distinct: bool = True,
    location: str | None = None,
) -> None:
    """One entry to all write modes, creating the table first if that is allowed. Rows are sorted within tasks as the
    specification says; WRITE_REPLACE also replaces columns, partitions and properties by those of the specification."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if not exists and create == CREATE_NEVER:
        raise ValueError(f"table {table} does not exist")
    if write == WRITE_REPLACE:
        create_or_replace_table_as(
            df, table, spec.partitions, spec.sort_by, distinct, fmt=spec.format, location=location, properties=spec.properties
        )
        return
    if not exists:
        create_table(spark, table, spec, location=location)
    if write == WRITE_TRUNCATE:
        insert_overwrite(df, table, distinct, sort_by=spec.sort_by)
    elif write == WRITE_APPEND:
        insert_append(df.distinct() if distinct else df, table, spec.sort_by)
    elif write == WRITE_EMPTY:
        if not spark.table(table).isEmpty():
            raise ValueError(f"table {table} already has rows")
        insert_append(df.distinct() if distinct else df, table, spec.sort_by)
    elif write == WRITE_MERGE:
        if not spec.key_columns:
            raise ValueError("a merge needs key columns")
        merge_into(df, table, spec.key_columns, distinct)
    else:
        raise ValueError(f"unknown write mode {write!r}")
