"""JDBC extract and replace. Connection details are always parameters."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_READ = 500_000


def extract_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Reader options for an extract query.

    The query is wrapped as a table because ``query`` cannot be combined with a partition column.
    """
    options = {"url": url, "dbtable": f"({query.strip().rstrip(';')}) extract_query", "fetchsize": str(fetch_size)}
    options.update(connection)
    if partition_column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("a partition column needs bounds and a number of partitions")
        lower, upper = bounds
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(num_partitions),
        )
    return options


def partitions_for(rows: int, rows_per_read: int = ROWS_PER_READ) -> int:
    return max(math.ceil(rows / rows_per_read), 1)


def spread_predicates(expression: str, n: int) -> list[str]:
    """One condition per read task over a whole-number SQL expression; together they take every row once."""
    rest = f"MOD(ABS({expression}), {n})"
    return [f"({rest} = {i}" + (f" OR {expression} IS NULL)" if i == 0 else ")") for i in range(n)]


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    spread_by: str | None = None,
    readers: int | None = None,
    **connection: str,
) -> DataFrame:
    """Result of an extract query, read by ``readers`` tasks, or one per ROWS_PER_READ rows.

    Each task runs the query with a condition of its own, and the database may scan all of the query's tables for each:
    where the condition has no index to use, choose few readers.

    The database first reports row count and range (one row). ``partition_column`` then cuts its range in equal
    parts, which suits a column spread evenly over it. Where values bunch up, ``spread_by`` names a whole-number
    expression of the database's SQL instead, such as ``CRC32(id)``, whose remainders are even.
    """
    plain = extract_options(url, query, **connection)
    if partition_column is None and spread_by is None:
        return spark.read.format("jdbc").options(**plain).load()
    bound = partition_column or "NULL"
    counted = extract_options(
        url, f"SELECT COUNT(*) AS n, MIN({bound}) AS lo, MAX({bound}) AS hi FROM {plain['dbtable']}", **connection
    )
    n, lo, hi = spark.read.format("jdbc").options(**counted).load().first()
    n_tasks = readers or partitions_for(int(n))
    if spread_by is not None:
        properties = {k: v for k, v in plain.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(
            url, plain["dbtable"], predicates=spread_predicates(spread_by, n_tasks), properties=properties
        )
    if lo is None:
        return spark.read.format("jdbc").options(**plain).load()
    options = extract_options(url, query, partition_column, (lo, hi), n_tasks, **connection)
    return spark.read.format("jdbc").options(**options).load()


def replace_options(url: str, table: str, batch_size: int = 10_000, **connection: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "truncate": "true", "batchsize": str(batch_size), **connection}


def replace_table(df: DataFrame, url: str, table: str, batch_size: int = 10_000, **connection: str) -> None:
    """Empties the database table (created if missing) and inserts every row, in batches per partition."""
    options = replace_options(url, table, batch_size, **connection)
    df.write.format("jdbc").options(**options).mode("overwrite").save()
