"""Listing texts, odd ones included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from khodat.functions import parsing as P


def apply(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in rows.select("i", function("x").alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize("function, cases", [
    (P.normalize_price, {
        "5,2 tỷ": 5.2, "800 triệu": 0.8, "950.000 đ": 0.00095, "7": 7.0, "1.2.3 đ": None, "7d": None, "1f tỷ": None,
        "5,2 tỷ": 5.2, "": None, "thỏa thuận": None, None: None, "2 triệu tỷ": None, " 3,5 tỷ ": 3.5, "1e2": 100.0,
        "1 200 tỷ": None, "-5": -5.0, "5.": 5.0, ",5": 0.5, ".": None,
    }),
    (P.normalize_price_m2, {
        "12,5 triệu/m²": 12.5, "1,2 tỷ/m²": 1200.0, "950.000 đ/m²": 0.95, "12": None, None: None, "x triệu/m²": None,
        "12 triệu": None,
    }),
    (P.parse_area, {"62,5 m²": 62.5, "70": 70.0, None: None, "rộng": None, "1.200,5 m²": None}),
    (P.first_integer, {
        "3 phòng": 3, "nhiều hơn 6": 6, "không": None, None: None, "2-3": 2, "": None, "9" * 30: None,
    }),
    (P.parse_floor, {"12": 12, " 7 ": 7, "3.0": None, "trệt": None, None: None, "+4": 4, "-1": -1}),
    (P.extract_ward, {
        "12 Phố X, Phường Trung Hòa, Quận Cầu Giấy, Hà Nội": "Trung Hòa", "Xã A, Huyện B": "", None: None,
    }),
    (P.extract_district, {"Phường A, Quận Cầu Giấy, Hà Nội": "Cầu Giấy", "Xã A, Huyện Đông Anh, Hà Nội": "", None: None}),
    (P.strip_boilerplate, {f"Vinhomes{P.PROJECT_BOILERPLATE}": "Vinhomes", "Vinhomes": "Vinhomes", None: None}),
    (P.cast_timestamp, {
        "2024-12-09 01:02:03.4": dt.datetime(2024, 12, 9, 1, 2, 3, 400000), "2024-12-09": dt.datetime(2024, 12, 9),
        "-1": None, "abc": None, None: None,
    }),
])
def test_texts(spark, function, cases):
    assert dict(zip(cases, apply(spark, function, cases))) == cases


def test_bad_text_is_null_without_ansi_too(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert apply(spark, P.parse_floor, ["3.0", "3x", "3"]) == [None, None, 3]
        assert apply(spark, P.first_integer, ["9" * 30]) == [None]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_total_is_rounded_half_up_on_the_decimal_digits(spark):
    rows = spark.createDataFrame([(1.005, 1000.0), (62.5, 12.5), (None, 1.0)], "area double, price_m2 double")
    assert [r[0] for r in rows.select(P.total_price("area", "price_m2")).collect()] == [1.01, 0.78, None]


LISTING = (
    "du_an string, price_VND double, toilet bigint, created_date string, other string, So_tang int",
    [("a", 1.5, 2, "2024", "x", 3), (None, None, None, None, None, None)],
)


def test_sentinels_there_and_back(spark):
    rows = spark.createDataFrame(LISTING[1], LISTING[0])
    filled = P.null_to_sentinel(rows)
    assert filled.collect()[1].asDict() == {
        "du_an": "-1", "price_VND": -1.0, "toilet": -1, "created_date": "-1", "other": "-1", "So_tang": -1,
    }
    assert filled.schema.simpleString() == rows.schema.simpleString()
    back = P.sentinel_to_null(filled).collect()
    assert back[0] == rows.collect()[0]
    # created_date keeps its -1, as does any column that is not a listing column.
    assert back[1].asDict() == {
        "du_an": None, "price_VND": None, "toilet": None, "created_date": "-1", "other": "-1", "So_tang": None,
    }


def test_links(spark):
    rows = spark.createDataFrame([("https://h.x/ban?page=3", "/a.htm")], "u string, h string")
    assert rows.select(P.resolve_link("u", "h")).first()[0] == "https://h.x/ban3/a.htm"
    assert rows.select(P.resolve_link("u", F.col("h"), origin_only=True)).first()[0] == "https://h.x/a.htm"
