"""Listing text to numbers and names, as column expressions that stay inside codegen.

A value that cannot be read becomes NULL; nothing here raises on bad text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Units of the price texts and the sentence shown behind a project name.
UNIT_BILLION = "tỷ"
UNIT_MILLION = "triệu"
UNIT_DONG = "đ"
PER_M2 = "/m²"
AREA_UNIT = "m²"
PROJECT_BOILERPLATE = "Nhấn để xem thông tin về dự án được sàng lọc uy tín và sát sao nhất thị trường"

# Patterns for ward and district in an address.
WARD_PATTERN = "Phường ([^,]+)"
DISTRICT_PATTERN = "Quận ([^,]+)"

# Columns in which -1 stands for a missing value (created_date is not one of them).
SENTINEL_COLUMNS = (
    "du_an", "price_VND", "location", "status", "area", "price_m2",
    "toilet", "room", "doc", "type", "So_tang", "furnishing",
)

_BLANKS = " \u00a0\u2007\u202f\u3000\t\r\n"


# What the casts accept: a sign, digits with at most one dot, an exponent.
_NUMBER = r"^[+-]?(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?$"
_INTEGER = r"^[+-]?[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _without(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def _trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(_BLANKS))


def _decimal_comma(text: Column) -> Column:
    """Double from text with a decimal comma or dot.

    The pattern comes first because a failed cast costs an exception per row, many times the price of the match.
    """
    clean = _trimmed(F.replace(text, F.lit(","), F.lit(".")))
    return F.when(clean.rlike(_NUMBER), clean.try_cast("double"))


def extract_ward(location: Column | str) -> Column:
    """Ward of an address; '' when there is none, NULL for a NULL address."""
    return F.regexp_extract(_col(location), WARD_PATTERN, 1)


def extract_district(location: Column | str) -> Column:
    """Urban district of an address; '' when there is none, NULL for a NULL address."""
    return F.regexp_extract(_col(location), DISTRICT_PATTERN, 1)


def total_price(area: Column | str, price_m2: Column | str) -> Column:
    """Area (m²) times price (million per m²), in billions, rounded half up to 2 places."""
    return F.round(_col(area) * _col(price_m2) / 1000, 2)


def cast_timestamp(text: Column | str) -> Column:
    return _col(text).try_cast("timestamp")


def normalize_price(text: Column | str) -> Column:
    """Price text in billions: millions and đ are scaled, a bare number counts as billions."""
    t = _col(text)
    million, dong = t.contains(UNIT_MILLION), t.contains(UNIT_DONG)
    unit = F.when(million, UNIT_MILLION).when(dong, UNIT_DONG).otherwise(UNIT_BILLION)
    number = _decimal_comma(F.replace(t, unit, F.lit("")))
    return number / F.when(million, 1000.0).when(dong, 1000000.0).otherwise(1.0)


def normalize_price_m2(text: Column | str) -> Column:
    """Price-per-m² text in millions; NULL without a known unit."""
    t = _col(text)
    units = [u + PER_M2 for u in (UNIT_MILLION, UNIT_BILLION, UNIT_DONG)]
    million, billion, dong = (t.contains(u) for u in units)
    unit = F.when(million, units[0]).when(billion, units[1]).when(dong, units[2])
    number = _decimal_comma(F.replace(t, unit, F.lit("")))
    # One number, scaled up or down: multiplying or dividing by 1 leaves a double as it is.
    return (
        number
        * F.when(billion & ~million, 1000.0).otherwise(1.0)
        / F.when(dong & ~million & ~billion, 1000.0).otherwise(1.0)
    )


def parse_area(text: Column | str) -> Column:
    return _decimal_comma(_without(_col(text), AREA_UNIT))


def first_integer(text: Column | str) -> Column:
    """First run of digits: "3 phòng" and "nhiều hơn 6" give 3 and 6."""
    t = _col(text)
    return F.when(t.rlike("[0-9]"), F.regexp_extract(t, "([0-9]+)", 1).try_cast("bigint"))


def parse_floor(text: Column | str) -> Column:
    """The whole text as an integer."""
    clean = _trimmed(_col(text))
    return F.when(clean.rlike(_INTEGER), clean.try_cast("bigint"))


def strip_boilerplate(name: Column | str, sentence: str = PROJECT_BOILERPLATE) -> Column:
    return _without(_col(name), sentence)


def resolve_link(page_url: Column | str, href: Column | str, origin_only: bool = False) -> Column:
    """Absolute address of a listing link found on an index page.

    By default the index page's address minus ``?page=`` is put in front, page number kept;
    ``origin_only`` puts just scheme and host in front.
    """
    url, path = _col(page_url), _col(href)
    if origin_only:
        return F.concat(
            F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("HOST")), path
        )
    return F.concat(_without(url, "?page="), path)


def _sentinel(dtype: T.DataType) -> Column:
    return F.lit("-1") if isinstance(dtype, T.StringType) else F.lit(-1).cast(dtype)


def _replace_columns(df: DataFrame, columns: Iterable[str], change) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    names = [c for c in columns if c in types]
    return df.withColumns({c: change(F.col(c), _sentinel(types[c])) for c in names})


def sentinel_to_null(df: DataFrame, columns: Iterable[str] = SENTINEL_COLUMNS) -> DataFrame:
    """-1 (numbers) and '-1' (text) become NULL in the given columns."""
    return _replace_columns(df, columns, F.nullif)


def null_to_sentinel(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NULL becomes -1 (numbers) or '-1' (text), by default in every numeric and text column."""
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.StringType))]
    return _replace_columns(df, columns, F.coalesce)
