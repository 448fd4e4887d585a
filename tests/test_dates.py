"""Business dates, formats, ranges, epochs, the date dimension and working days."""

import datetime as dt

import pandas as pd
import pytest
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from khodat.functions import dates as D
from khodat.functions import workdays as W
from khodat.schema import Partition, struct


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def ts(text):
    return F.lit(text).cast("timestamp")


def test_patterns():
    assert D.spark_pattern("%Y%m%d") == "yyyyMMdd"
    assert D.spark_pattern("yyyy-MM") == "yyyy-MM"
    assert D.spark_pattern("%Y-%m-%d %H:%M:%S.%f%z") == "yyyy-MM-dd HH:mm:ss.SSSSSSxx"
    assert D.spark_pattern("%dT%H") == "dd'T'HH"
    with pytest.raises(ValueError):
        D.spark_pattern("%Q")


def test_business_date(spark):
    anchor = ts("2024-12-09 23:30:00")
    assert one(spark, D.business_date(None, anchor)) == "20241209"
    assert one(spark, D.business_date(F.lit("None"), anchor, days=-1, fmt="%Y-%m-%d")) == "2024-12-08"
    assert one(spark, D.business_date(F.lit("20200101"), anchor)) == "20200101"
    assert one(spark, D.business_date(F.lit(None).cast("string"), anchor, days=1)) == "20241210"
    assert len(one(spark, D.business_date())) == 8


def test_parse_and_format(spark):
    assert one(spark, D.parse_date(F.lit("20241209"))) == dt.datetime(2024, 12, 9)
    assert one(spark, D.parse_date(F.lit("x"), strict=False)) is None
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        one(spark, D.parse_date(F.lit("x")))
    assert one(spark, D.format_date(ts("2024-12-09 01:02:03.004005"), "%Y-%m-%d %H:%M:%S.%f")) == "2024-12-09 01:02:03.004005"


def test_range(spark):
    assert one(spark, D.date_range(F.lit("2024-02-28"), F.lit("2024-03-01"))) == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert one(spark, D.date_range(F.lit("2024-02-28"), F.lit("2024-02-28"), "%Y%m%d")) == ["20240228"]
    assert one(spark, D.date_range(F.lit("2024-02-28"), F.lit("2024-02-27"))) == []
    assert one(spark, D.date_range(F.lit(None).cast("date"), F.lit("2024-02-27"))) is None


def test_epoch(spark):
    assert one(spark, D.datetime_to_epoch(ts("1970-01-02 00:00:00.5"))) == 86400.5
    assert one(spark, D.epoch_to_datetime(F.lit(1733706123.456789))) == dt.datetime(2024, 12, 9, 1, 2, 3, 456789)
    assert one(spark, D.epoch_to_datetime(F.lit(-0.5))) == dt.datetime(1969, 12, 31, 23, 59, 59, 500000)


def test_yesterday_and_midnight(spark):
    assert one(spark, D.yesterday(ts("2024-03-01 10:00:00"))) == "2024-02-29"
    day = ts("2024-12-09 10:00:00")
    assert one(spark, D.midnight_to_utc(day)) == "2024-12-09 00:00:00.000000+0000"
    assert one(spark, D.midnight_to_utc(day, "Asia/Ho_Chi_Minh", -2)) == "2024-12-06 17:00:00.000000+0000"
    assert one(spark, D.midnight_to_utc(ts("2024-07-01"), "America/New_York")) == "2024-07-01 04:00:00.000000+0000"


def test_day_partition(spark):
    rows = spark.range(1).select(ts("2024-12-09 10:00:00").alias("t"))
    by_day, name = D.day_partition(rows, Partition("t", "DAY"))
    assert (name, by_day.first().t_day) == ("t_day", dt.date(2024, 12, 9))
    assert D.day_partition(rows, Partition("t"))[1] == "t"
    assert D.day_partition(rows, Partition("t", "NONE"))[1] is None
    with pytest.raises(ValueError):
        Partition("t", "HOUR")


def test_date_dimension(spark):
    days = D.days_covering(spark.createDataFrame([("2023-12-31",), ("2024-01-02",)], "d string"), "d")
    rows = D.date_dimension(days)
    declared = struct(
        date="date", day_of_week="integer", day_of_month="integer", week="integer", month="integer", quarter="integer",
        quarter_name="string", year="integer", month_full_name="string", week_day="string",
    )
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in declared]
    assert [tuple(r) for r in rows.orderBy("date").collect()][1] == (
        dt.date(2024, 1, 1), 2, 1, 1, 1, 1, "Q1", 2024, "January", "Monday",
    )
    assert D.days_covering(spark.createDataFrame([], "d date"), "d").count() == 0


@pytest.fixture(scope="module")
def calendar():
    """Every day of 1970-2200 with the nearest working days, worked out day by day."""
    holidays = {d.date() for d in USFederalHolidayCalendar().holidays("1969-01-01", "2201-12-31")}
    works = lambda d: d.weekday() < 5 and d not in holidays
    found = {}
    for stamp in pd.date_range("1970-01-01", "2200-12-31"):
        d = nxt = prev = stamp.date()
        while not works(nxt):
            nxt += dt.timedelta(1)
        while not works(prev):
            prev -= dt.timedelta(1)
        found[d] = (d in holidays, works(d), nxt, prev)
    return found


def test_workdays_of_two_centuries(spark, calendar):
    days = spark.sql("select explode(sequence(date'1970-01-01', date'2200-12-31')) as d")
    rows = days.select(
        "d", W.is_federal_holiday("d"), W.is_workday("d"), W.next_workday("d"), W.previous_workday("d")
    ).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == calendar
    assert one(spark, W.next_workday(F.lit(None).cast("date"))) is None


def interval(spark, column):
    found = one(spark, column)
    return None if found is None else (found.start, found.end)


def test_run_intervals(spark):
    day = lambda n, h=0: dt.datetime(2024, 12, n, h)
    none = F.lit(None).cast("timestamp")
    # 2024-12-25 is a Wednesday; 7 and 8 December are a weekend.
    assert interval(spark, W.previous_workday_interval(ts("2024-12-09 05:00:00"))) == (day(6), day(7))
    assert interval(spark, W.previous_workday_interval(ts("2024-12-26"))) == (day(24), day(25))
    assert interval(spark, W.next_run_interval(ts("2024-12-06"))) == (day(9), day(10))
    assert interval(spark, W.next_run_interval(ts("2024-12-24"), latest=ts("2024-12-25"))) is None
    assert interval(spark, W.next_run_interval(ts("2024-12-24"), latest=ts("2024-12-26"))) == (day(26), day(27))
    assert interval(spark, W.next_run_interval(none)) is None
    assert interval(spark, W.next_run_interval(none, earliest=ts("2024-12-06"))) == (day(6), day(7))
    assert interval(spark, W.next_run_interval(none, earliest=ts("2024-12-06 00:30:00"))) == (day(9), day(10))
    today = F.lit("2024-12-10").cast("date")
    assert interval(spark, W.next_run_interval(none, ts("2024-12-06 00:30:00"), today=today)) == (day(10), day(11))
    later = ts("2024-12-11 10:00:00")
    assert interval(spark, W.next_run_interval(none, later, today=today)) == (day(11, 10), day(12, 10))
