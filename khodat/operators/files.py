"""File sinks of the raw layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from khodat.operators.rows import sized_for_write


def write_parquet(df: DataFrame, path: str, overwrite: bool = False, by: Sequence[str] = ()) -> None:
    """Adds files to the directory, or replaces it.

    With partition columns, replacing touches only the partitions present in ``df``, so one date can be rerun.
    """
    writer = sized_for_write(df, by=by).write.mode("overwrite" if overwrite else "append")
    if by:
        writer = writer.partitionBy(*by)
        if overwrite:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV that read_csv reads back: quotes are doubled, blanks kept, NULL is an empty field."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
