"""Business dates, formats, epochs, partition days and the date dimension."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khodat.schema import Partition

# Strftime code -> Spark datetime pattern.
STRFTIME_PATTERNS = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss",
    "f": "SSSSSS", "z": "xx", "p": "a", "j": "DDD", "B": "MMMM", "b": "MMM", "A": "EEEE", "a": "EEE", "%": "%",
}


# Name of the column a DAY partition adds, after that of its timestamp.
DAY_SUFFIX = "_day"


def spark_pattern(fmt: str) -> str:
    """Spark datetime pattern of ``fmt``, which may use strftime codes."""
    if "%" not in fmt:
        return fmt

    def one(match: re.Match) -> str:
        code, other = match.group(1), match.group(2)
        if code is None:
            return "''" if other == "'" else f"'{other}'" if other.isalpha() else other
        if code not in STRFTIME_PATTERNS:
            raise ValueError(f"no Spark pattern for %{code}")
        return STRFTIME_PATTERNS[code]

    return re.sub(r"%(.)|(.)", one, fmt, flags=re.S)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def business_date(
    given: Column | str | None = None, anchor: Column | str | None = None, days: int = 0, fmt: str = "yyyyMMdd"
) -> Column:
    """The given date text, or ``anchor`` (now) plus ``days`` where it is NULL or "None"."""
    base = F.current_timestamp() if anchor is None else _col(anchor)
    computed = F.date_format(base + F.make_interval(days=F.lit(days)), spark_pattern(fmt))
    return computed if given is None else F.coalesce(F.nullif(_col(given), F.lit("None")), computed)


def parse_date(text: Column | str, fmt: str = "yyyyMMdd", strict: bool = True) -> Column:
    """Timestamp from text; bad text raises, or gives NULL when not ``strict``."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    pattern = spark_pattern(fmt)
    return parse(_col(text), pattern if strict else F.lit(pattern))


def format_date(value: Column | str, fmt: str = "yyyyMMdd") -> Column:
    return F.date_format(_col(value), spark_pattern(fmt))


def date_range(start: Column | str, end: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Array of all dates from start to end, both included, as text; empty when end lies before start."""
    first, last = _col(start).cast("date"), _col(end).cast("date")
    days = F.when(last < first, F.array().cast("array<date>")).otherwise(
        F.sequence(first, F.greatest(first, last), F.expr("interval 1 day"))
    )
    pattern = spark_pattern(fmt)
    return F.transform(days, lambda d: F.date_format(d, pattern))


def yesterday(anchor: Column | str | None = None) -> Column:
    base = F.current_date() if anchor is None else _col(anchor)
    return F.date_format(F.date_sub(base, 1), "yyyy-MM-dd")


def datetime_to_epoch(value: Column | str) -> Column:
    """Seconds since the epoch as a double; a zone-less value is taken in the session zone."""
    return _col(value).cast("timestamp").cast("double")


def epoch_to_datetime(seconds: Column | str) -> Column:
    return F.timestamp_micros(F.round(_col(seconds) * 1000000).cast("bigint"))


def midnight_to_utc(value: Column | str, zone: str = "UTC", days: int = 0) -> Column:
    """Midnight of the day ``days`` after ``value`` in ``zone``, as UTC text with offset +0000."""
    midnight = F.date_add(_col(value), days).cast("timestamp_ntz")
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight)
    return F.concat(F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+0000"))


def day_partition(df: DataFrame, partition: Partition) -> tuple[DataFrame, str | None]:
    """Frame and column name to partition a write by.

    ``DAY`` adds ``<column>_day``; every other kind uses the column as it is, ``NONE`` none at all.
    """
    if partition.kind == "NONE":
        return df, None
    if partition.kind == "DAY":
        name = f"{partition.column}{DAY_SUFFIX}"
        return df.withColumn(name, F.to_date(partition.column)), name
    return df, partition.column


def date_dimension(days: DataFrame, date: str = "date") -> DataFrame:
    """The calendar attributes of every date in ``days``."""
    d = F.col(date)
    return days.select(
        d.alias("date"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        F.year(d).alias("year"),
        F.date_format(d, "MMMM").alias("month_full_name"),
        F.date_format(d, "EEEE").alias("week_day"),
    )


def days_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day between the least and the greatest value of ``column``.

    A single min/max aggregation; the number of days is bounded by the calendar, not by the rows.
    """
    value = F.col(column).cast("date")
    bounds = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return bounds.where("lo is not null").select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
