"""Parsers, sentinels, dates and working days."""

from __future__ import annotations

from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from khodat.checks import data
from khodat.checks.registry import query
from khodat.functions import dates as D
from khodat.functions import parsing as P
from khodat.functions import workdays as W
from khodat.schema import Partition

KEYS = ["l_orderkey", "l_linenumber"]


def _parser(name: str, column: str, function, output: str, sql: str) -> None:
    """A query that applies one parser to one text column of the listings."""

    @query(name, f"select l_orderkey, l_linenumber, {column} as input, {sql} as {output} from ({data.TEXTS_SQL}) t")
    def run(spark, sf):
        return data.listing_texts(spark, sf).select(*KEYS, F.col(column).alias("input"), function(column).alias(output))


_parser("extract_ward", "location", P.extract_ward, "phuong", "regexp_extract(location, 'Phường ([^,]+)', 1)")
_parser("extract_district", "location", P.extract_district, "quan", "regexp_extract(location, 'Quận ([^,]+)', 1)")
_parser("cast_timestamp", "created_date", P.cast_timestamp, "created_at", "try_cast(created_date as timestamp)")
_parser("normalize_price_m2", "price_m2", P.normalize_price_m2, "price_million_m2", data.price_m2_sql("price_m2"))
_parser("normalize_price", "price", P.normalize_price, "price_billion", data.price_sql("price"))
_parser("parse_area", "area", P.parse_area, "area_m2", data.area_sql("area"))
_parser("first_integer", "room", P.first_integer, "rooms", data.integer_sql("room"))
_parser("parse_floor", "floor", P.parse_floor, "floors", "try_cast(trim(floor) as bigint)")
_parser("strip_boilerplate", "du_an", P.strip_boilerplate, "project",
        f"replace(du_an, '{P.PROJECT_BOILERPLATE}', '')")


@query("total_price", f"select area, price_m2, {data.TOTAL_SQL} as total from ({data.LISTINGS_SQL}) l")
def total_price(spark, sf):
    return data.listings(spark, sf).select("area", "price_m2", P.total_price("area", "price_m2").alias("total"))


SENTINEL_TEXTS = {
    "l_orderkey": "l_orderkey",
    "area": "case when l_linenumber = 1 then -1 else l_quantity end",
    "toilet": "case when l_linenumber = 2 then -1 else l_suppkey end",
    "So_tang": "case when l_linenumber = 3 then -1 else l_linenumber end",
    "doc": "case when l_linenumber = 4 then '-1' else l_returnflag end",
    "created_date": "case when l_linenumber = 5 then '-1' else l_linestatus end",
}


@query(
    "sentinel_to_null",
    "select l_orderkey, nullif(area, -1) as area, nullif(toilet, -1) as toilet, nullif(\"So_tang\", -1) as \"So_tang\", "
    "nullif(doc, '-1') as doc, created_date from (select "
    + ", ".join(f'{e} as "{n}"' for n, e in SENTINEL_TEXTS.items()) + " from lineitem) t",
)
def sentinel_to_null(spark, sf):
    lines = data.table(spark, sf, "lineitem").selectExpr(*[f"{e} as {n}" for n, e in SENTINEL_TEXTS.items()])
    return P.sentinel_to_null(lines)


@query(
    "null_to_sentinel",
    "select " + ", ".join(
        f"coalesce({c}, {v}) as {c}" for c, v in {
            "du_an": "'-1'", '"price_VND"': "-1", "location": "'-1'", "status": "'-1'", "area": "-1",
            "price_m2": "-1", "toilet": "-1", "room": "-1", "doc": "'-1'", "type": "'-1'", '"So_tang"': "-1",
            "furnishing": "'-1'", "created_date": "'-1'",
        }.items()
    ) + f" from ({data.LISTINGS_SQL}) l",
)
def null_to_sentinel(spark, sf):
    return P.null_to_sentinel(data.listings(spark, sf))


@query(
    "resolve_link",
    "select page_id, url, replace(url, '?page=', '') || '/tin/' || page_id || '.htm' as link, "
    "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || '/tin/' || page_id || '.htm' as site_link from pages",
)
def resolve_link(spark, sf):
    href = F.concat(F.lit("/tin/"), F.col("page_id").cast("string"), F.lit(".htm"))
    return data.table(spark, sf, "pages").select(
        "page_id", "url", P.resolve_link("url", href).alias("link"),
        P.resolve_link("url", href, origin_only=True).alias("site_link"),
    )


@query(
    "business_date",
    "select o_orderkey, case when o_orderstatus = 'O' then '20240101' "
    "else strftime(o_orderdate + interval 1 day, '%Y%m%d') end as business_date from orders",
)
def business_date(spark, sf):
    given = F.expr("case o_orderstatus when 'O' then '20240101' when 'F' then 'None' end")
    return data.table(spark, sf, "orders").select(
        "o_orderkey", D.business_date(given, "o_orderdate", days=1, fmt="%Y%m%d").alias("business_date")
    )


@query("parse_date", "select o_orderkey, o_orderdate as parsed, cast(null as timestamp) as lenient from orders")
def parse_date(spark, sf):
    text = F.date_format("o_orderdate", "yyyyMMdd")
    return data.table(spark, sf, "orders").select(
        "o_orderkey", D.parse_date(text, "%Y%m%d").alias("parsed"),
        D.parse_date(F.concat(text, F.lit("x")), "%Y%m%d", strict=False).alias("lenient"),
    )


@query(
    "format_date",
    "select event_id, strftime(ts, '%Y%m%d') as day, strftime(ts, '%d/%m/%Y %H:%M:%S.%f') as moment from events",
)
def format_date(spark, sf):
    return data.table(spark, sf, "events").select(
        "event_id", D.format_date("ts").alias("day"), D.format_date("ts", "%d/%m/%Y %H:%M:%S.%f").alias("moment")
    )


@query(
    "date_range",
    "select o_orderkey, strftime(unnest(generate_series(cast(o_orderdate as date), "
    "cast(o_orderdate as date) + cast(o_orderkey % 7 - 1 as integer), interval 1 day)), '%Y-%m-%d') as day from orders",
)
def date_range(spark, sf):
    end = F.expr("date_add(o_orderdate, cast(o_orderkey % 7 - 1 as int))")
    return data.table(spark, sf, "orders").select("o_orderkey", F.explode(D.date_range("o_orderdate", end)).alias("day"))


@query("yesterday", "select o_orderkey, strftime(o_orderdate - interval 1 day, '%Y-%m-%d') as yesterday from orders")
def yesterday(spark, sf):
    return data.table(spark, sf, "orders").select("o_orderkey", D.yesterday("o_orderdate").alias("yesterday"))


@query("datetime_to_epoch", "select event_id, epoch(ts) as seconds from events")
def datetime_to_epoch(spark, sf):
    return data.table(spark, sf, "events").select("event_id", D.datetime_to_epoch("ts").alias("seconds"))


@query("epoch_to_datetime", "select event_id, ts as moment from events")
def epoch_to_datetime(spark, sf):
    events = data.table(spark, sf, "events").select("event_id", D.datetime_to_epoch("ts").alias("seconds"))
    return events.select("event_id", D.epoch_to_datetime("seconds").alias("moment"))


@query(
    "midnight_tz_to_utc",
    "select event_id, strftime(date_trunc('day', ts) + interval 1 day - interval 7 hour, '%Y-%m-%d %H:%M:%S.%f') "
    "|| '+0000' as older_than from events",
)
def midnight_tz_to_utc(spark, sf):
    return data.table(spark, sf, "events").select(
        "event_id", D.midnight_to_utc("ts", "Asia/Ho_Chi_Minh", days=1).alias("older_than")
    )


@query("day_partition", "select event_id, ts, cast(ts as date) as ts_day from events")
def day_partition(spark, sf):
    rows, _ = D.day_partition(data.table(spark, sf, "events").select("event_id", "ts"), Partition("ts", "DAY"))
    return rows


@query(
    "date_dimension",
    "select d as date, dayofweek(d) + 1 as day_of_week, dayofmonth(d) as day_of_month, weekofyear(d) as week, "
    "month(d) as month, quarter(d) as quarter, 'Q' || quarter(d) as quarter_name, year(d) as year, "
    "monthname(d) as month_full_name, dayname(d) as week_day from (select cast(unnest(generate_series("
    "min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as d from orders) days",
)
def date_dimension(spark, sf):
    return D.date_dimension(D.days_covering(data.table(spark, sf, "orders"), "o_orderdate"))


HOLIDAYS = ", ".join(
    f"date '{d:%Y-%m-%d}'" for d in USFederalHolidayCalendar().holidays("1990-01-01", "2030-12-31")
)
WORKDAYS = (
    "with workdays as (select cast(d as date) as d from generate_series(timestamp '1990-01-01', timestamp '2030-12-31', "
    f"interval 1 day) g(d) where dayofweek(d) between 1 and 5 and cast(d as date) not in ({HOLIDAYS})) "
)


@query(
    "next_workday",
    WORKDAYS + "select o_orderkey, cast(o_orderdate as date) as day, (select min(d) from workdays "
    "where d >= cast(o_orderdate as date)) as workday from orders",
)
def next_workday(spark, sf):
    return data.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), W.next_workday("o_orderdate").alias("workday")
    )


@query(
    "previous_workday_interval",
    WORKDAYS + "select o_orderkey, cast(s as timestamp) as interval_start, s + interval 1 day as interval_end from ("
    "select o_orderkey, (select max(d) from workdays where d < cast(o_orderdate as date)) as s from orders) t",
)
def previous_workday_interval(spark, sf):
    runs = data.table(spark, sf, "orders").select("o_orderkey", W.previous_workday_interval("o_orderdate").alias("i"))
    return runs.select("o_orderkey", F.col("i.start").alias("interval_start"), F.col("i.end").alias("interval_end"))


@query(
    "next_run_interval",
    WORKDAYS + "select o_orderkey, case when s <= date '2001-06-30' then cast(s as timestamp) end as run_start, "
    "case when s <= date '2001-06-30' then s + interval 1 day end as run_end from (select o_orderkey, "
    "(select min(d) from workdays where d > cast(o_orderdate as date)) as s from orders) t",
)
def next_run_interval(spark, sf):
    # Orders in state P have no previous run: their earliest time is ten o'clock, moved up to the next midnight.
    last = F.expr("case when o_orderstatus <> 'P' then o_orderdate end")
    earliest = F.expr("o_orderdate + interval 10 hours")
    run = W.next_run_interval(last, earliest, F.lit("2001-06-30").cast("date"))
    return data.table(spark, sf, "orders").select("o_orderkey", run.alias("r")).select(
        "o_orderkey", F.col("r.start").alias("run_start"), F.col("r.end").alias("run_end")
    )
