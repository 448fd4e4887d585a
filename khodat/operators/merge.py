"""Key-based upsert of one frame into another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A target row matches more than one source row."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def same_keys(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(and_, [F.col(f"{left}.{quoted(k)}") == F.col(f"{right}.{quoted(k)}") for k in keys])


def check_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raises if several source rows share a key that exists in the target.

    Only keys are read, and counted before they are shuffled. The target is looked at only when the source
    does repeat a key.
    """
    names = [quoted(k) for k in keys]
    known = reduce(and_, [F.col(n).isNotNull() for n in names])
    repeated = source.select(*names).where(known).groupBy(*names).count().where("count > 1")
    if repeated.isEmpty():
        return
    matches = same_keys(keys, "s", "t")
    clash = repeated.alias("s").join(target.select(*names).alias("t"), matches, "left_semi").first()
    if clash is not None:
        raise DuplicateKeyError(f"source holds {clash['count']} rows for one target key {clash.asDict()}")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], dedup: bool = True, small_source: bool = False
) -> DataFrame:
    """Target after: matched rows take every source value, unmatched source rows are added.

    A NULL key matches nothing. Several target rows with one key are all updated.

    A key that fills much of the target does not end in one task: the update keeps the target on the left of its
    join, where AQE splits oversized partitions, and the insert sees each target key once per map task.
    ``small_source`` says that the source has been found small enough to broadcast; then neither needs a shuffle
    of the target.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("a merge needs key columns")
    columns = target.columns
    names = [quoted(k) for k in keys]
    rows = source.select(*map(quoted, columns))
    if dedup:
        rows = rows.distinct()
    check_single_match(target, rows, keys)

    if small_source:
        rows = F.broadcast(rows)
    found = rows.withColumn("_found", F.lit(True)).alias("s")
    updated = target.alias("t").join(found, same_keys(keys, "t", "s"), "left_outer").select(
        *[F.when(F.col("s._found"), F.col(f"s.{quoted(c)}")).otherwise(F.col(f"t.{quoted(c)}")).alias(c) for c in columns]
    )
    present = target.select(*names)
    if small_source:
        present = present.alias("t").join(rows.select(*names).alias("s"), same_keys(keys, "t", "s"), "left_semi")
    added = rows.alias("s").join(present.distinct().alias("t"), same_keys(keys, "s", "t"), "left_anti")
    return updated.unionByName(added)
