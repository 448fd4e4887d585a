"""Counting, dedup, output sizing, concatenation and newest-per-group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khodat.schema import ROWS_PER_PARTITION


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedup: copies collapse before the shuffle, so a row repeated very often stays cheap."""
    return df.distinct()


def partition_count(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Row count and the number of output partitions it asks for, at least one."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_rows"), F.greatest(F.ceil(n / F.lit(float(rows_per_partition))), F.lit(1)).alias("n_partitions")
    )


def sized_for_write(df: DataFrame, num_partitions: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Frame in output-sized partitions: ``num_partitions`` if given, else by size.

    Sizing by size needs no counting pass. With partition columns their rows are brought together, small groups
    merged and oversized ones split, so a hot partition value does not end in one task. Without them the frame
    stays as it is: scans are split and shuffles merged by size already, and another shuffle would gain nothing.
    """
    names = [F.col("`" + c.replace("`", "``") + "`") for c in by]
    if num_partitions:
        # With partition columns too: each value in few tasks, not each task with all values.
        return df.hint("rebalance", num_partitions, *names) if by else df.repartition(num_partitions)
    return df.hint("rebalance", *names) if by else df


def ranged_for_write(df: DataFrame, order: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Frame in partitions that each hold a range of the ``order`` columns and are sorted by them.

    Bounds are quantiles of a sample. Neighbouring ranges share at most the value at their bound; so one that fills several of
    them is split, by the hash of all columns. Without ``num_partitions`` small neighbours are merged by size.
    """
    names = [F.col("`" + c.replace("`", "``") + "`") for c in order]
    hashable = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    bounds = [*names, F.xxhash64(*hashable)] if hashable else names
    ranged = df.repartitionByRange(num_partitions, *bounds) if num_partitions else df.repartitionByRange(*bounds)
    return ranged.sortWithinPartitions(*names)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Frame dealt by the hash of ``by`` over as many tasks as ``spark.sql.shuffle.partitions`` says, however few bytes it has.

    For narrow rows before a step that makes much of each: splits and merged shuffles are sized by bytes, so a million of
    them would end in one task.
    """
    names = [F.col("`" + c.replace("`", "``") + "`") for c in by]
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *names)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenation by column name; a column missing from a frame is NULL there. Neighbours are joined in pairs, so that
    the plan of many frames stays flat."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = zip(frames[::2], frames[1::2])
        frames = [a.unionByName(b, allowMissingColumns=True) for a, b in pairs] + frames[len(frames) // 2 * 2 :]
    return frames[0]


def newest(listing: DataFrame, by: Sequence[str] = (), path: str = "path", mtime: str = "mtime") -> DataFrame:
    """The most recently modified file, the greatest path among equals; per group if ``by`` is given."""
    if not by:
        return listing.orderBy(F.desc(mtime), F.desc(path)).limit(1).select(path, mtime)
    return listing.groupBy(*by).agg(F.max(F.struct(mtime, path)).alias("_newest")).select(
        *by, F.col(f"_newest.{path}").alias(path), F.col(f"_newest.{mtime}").alias(mtime)
    )
