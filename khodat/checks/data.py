"""Listings, listing pages and index pages derived from the test tables.

The expressions are plain SQL that Spark and DuckDB read alike, so both sides start from the same texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from khodat.functions.parsing import PROJECT_BOILERPLATE
from khodat.operators.rows import spread
from khodat.plans.ingest import normalize_listing
from khodat.schema import LISTING_RAW
from khodat.sources.html import PRICE_CLASS, VALUE_CLASS, listing_fields


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Listing texts of one line item: the offered part, its supplier's place, prices with all units and all the
# ways a crawled text can be odd.
LISTING_TEXTS = {
    "du_an": f"case when l_linenumber % 4 = 0 then null else p_name || '{PROJECT_BOILERPLATE}' end",
    "price": "cast(cast(l_quantity as bigint) as string) || ',' || cast(l_partkey % 10 as string) || "
             "case l_linenumber % 4 when 0 then ' tỷ' when 1 then ' triệu' when 2 then ' đ' else '' end",
    "location": "'Phố ' || s_name || ', Phường ' || n_name || case when n_nationkey % 5 = 0 then ', Huyện ' "
                "else ', Quận ' end || r_name || ', Hà Nội'",
    "status": "p_brand",
    "area": "cast(30 + p_size as string) || ',5 m²'",
    "price_m2": "cast(p_size as string) || ',' || cast(l_partkey % 10 as string) || case l_linenumber % 4 "
                "when 0 then ' triệu/m²' when 1 then ' tỷ/m²' when 2 then ' đ/m²' else '' end",
    "toilet": "case when l_linenumber % 5 = 0 then null else cast(1 + l_partkey % 4 as string) || ' phòng' end",
    "room": "case when l_linenumber = 7 then null when l_linenumber = 6 then 'nhiều hơn 6' when l_linenumber = 5 "
            "then 'không' else cast(1 + l_partkey % 5 as string) || ' phòng' end",
    "doc": "l_returnflag",
    "type": "p_type",
    "floor": "case when l_linenumber = 6 then 'trệt' else cast(l_partkey % 9 as string) end",
    "furnishing": "l_linestatus",
    "created_date": "case when l_linenumber = 7 then null when l_linenumber = 6 then '-1' when l_linenumber = 5 "
                    "then 'abc' else cast(l_shipdate as string) end",
}

TEXTS_SQL = "select l_orderkey, l_linenumber, " + ", ".join(f"{e} as {n}" for n, e in LISTING_TEXTS.items()) + (
    " from lineitem join part on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey"
    " join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey"
)


def listing_texts(spark: SparkSession, sf: str) -> DataFrame:
    lineitem, part, supplier, nation, region = (
        table(spark, sf, n) for n in ("lineitem", "part", "supplier", "nation", "region")
    )
    joined = (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.selectExpr("l_orderkey", "l_linenumber", *[f"{e} as {n}" for n, e in LISTING_TEXTS.items()])


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """Typed listings: the columns of the raw table, created_date still text."""
    typed = normalize_listing(listing_texts(spark, sf)).withColumnRenamed("Số tầng", "So_tang")
    return typed.select(*LISTING_RAW.columns)


def number_sql(text: str, unit: str) -> str:
    return f"try_cast(trim(replace(replace({text}, '{unit}', ''), ',', '.')) as double)"


def price_sql(c: str) -> str:
    return (
        f"case when contains({c}, 'triệu') then {number_sql(c, 'triệu')} / 1000"
        f" when contains({c}, 'đ') then {number_sql(c, 'đ')} / 1000000 else {number_sql(c, 'tỷ')} end"
    )


def price_m2_sql(c: str) -> str:
    return (
        f"case when contains({c}, 'triệu/m²') then {number_sql(c, 'triệu/m²')}"
        f" when contains({c}, 'tỷ/m²') then {number_sql(c, 'tỷ/m²')} * 1000"
        f" when contains({c}, 'đ/m²') then {number_sql(c, 'đ/m²')} / 1000 end"
    )


def area_sql(c: str) -> str:
    return number_sql(c, "m²")


def integer_sql(c: str) -> str:
    return f"try_cast(regexp_extract({c}, '[0-9]+') as bigint)"


def typed_sql(texts: str, floor: str = "So_tang", first: str = "", last: str = "") -> str:
    """SQL of normalize_listing over a select of the texts, with further columns before and after."""
    return (
        f"select {first}replace(du_an, '{PROJECT_BOILERPLATE}', '') as du_an, {price_sql('price')} as \"price_VND\","
        f" location, status, {area_sql('area')} as area, {price_m2_sql('price_m2')} as price_m2,"
        f" {integer_sql('toilet')} as toilet, {integer_sql('room')} as room, doc, type,"
        f' try_cast(trim(floor) as bigint) as "{floor}", furnishing{last} from ({texts}) texts'
    )


LISTINGS_SQL = typed_sql(TEXTS_SQL, last=", created_date")
# Half up on the decimal digits of the double, as Spark rounds.
TOTAL_SQL = "cast(round(cast(cast(area * price_m2 / 1000 as varchar) as decimal(38, 15)), 2) as double)"


def warehouse_sql(staging: str) -> str:
    return (
        'select du_an, "price_VND", status, area, price_m2, toilet, room, doc, type, "So_tang", furnishing,'
        " regexp_extract(location, 'Phường ([^,]+)', 1) as phuong,"
        " regexp_extract(location, 'Quận ([^,]+)', 1) as quan,"
        f" try_cast(created_date as timestamp) as created_date, {TOTAL_SQL} as total from ({staging}) staging"
    )


# Texts of one listing page per part; NULL where the page lacks the element.
PAGE_TEXTS = {
    "du_an": f"case when p_partkey % 4 = 0 then null else p_name || '{PROJECT_BOILERPLATE}' end",
    "price": "cast(p_size as string) || ',' || cast(p_partkey % 10 as string) || "
             "case p_partkey % 3 when 0 then ' tỷ' when 1 then ' triệu' else ' đ' end",
    "location": "'Phường ' || n_name || case when n_nationkey % 5 = 0 then ', Huyện ' else ', Quận ' end || r_name",
    "status": "p_brand",
    "area": "cast(30 + p_size as string) || ',5 m²'",
    "price_m2": "cast(p_size as string) || case p_partkey % 4 when 0 then ' triệu/m²' when 1 then ',5 tỷ/m²' "
                "when 2 then '.500 đ/m²' else null end",
    "toilet": "case when p_partkey % 5 = 0 then null else cast(1 + p_partkey % 4 as string) || ' phòng' end",
    "room": "case when p_partkey % 7 = 0 then null when p_partkey % 11 = 0 then 'nhiều hơn 6' "
            "else cast(1 + p_partkey % 5 as string) || ' phòng' end",
    "doc": "case when p_partkey % 2 = 0 then 'Sổ đỏ & sổ hồng' else 'Đang chờ sổ <mới>' end",
    "type": "p_type",
    "floor": "case when p_partkey % 6 = 0 then null else cast(p_partkey % 40 as string) end",
    "furnishing": "case when p_partkey % 3 = 0 then '' else 'Nội thất đầy đủ' end",
}
LISTINGS_PER_INDEX = 20
INDEX_URL = "https://listings.example/ban-can-ho"

_PAGES_FROM = " from part join nation on n_nationkey = p_partkey % 25 join region on r_regionkey = n_regionkey"
PAGE_URL_SQL = (
    f"'{INDEX_URL}' || cast(p_partkey // {LISTINGS_PER_INDEX} as string) || '/ban/' || cast(p_partkey as string) || '.htm'"
)
PAGE_TEXTS_SQL = (
    f"select p_partkey as page_id, {PAGE_URL_SQL} as url, "
    + ", ".join(f"{e} as {n}" for n, e in PAGE_TEXTS.items()) + _PAGES_FROM
)


def _escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def _markup(field, text: Column) -> Column:
    """The element of one field, nothing for NULL. A later copy must lose against the first."""
    attributes = f' class="{field.css_class}"' + (f' itemprop="{field.itemprop}"' if field.itemprop else "")
    body = _escaped(text)
    if field.inner:
        body = F.concat(F.lit('<a href="#"><i>'), body, F.lit("</i></a>"))
        text_or_none = F.coalesce(body, F.lit("<i>không có liên kết</i>"))
        return F.concat(F.lit(f"<{field.tag}{attributes}>"), text_or_none, F.lit(f"</{field.tag}>"))
    element = F.concat(F.lit(f"<{field.tag}{attributes}>"), body, F.lit(f"</{field.tag}><br>"))
    later = F.lit(f"<{field.tag}{attributes}>bản sao</{field.tag}>")
    return F.when(text.isNull(), "").otherwise(F.concat(element, later))


def page_texts(spark: SparkSession, sf: str) -> DataFrame:
    part, nation, region = (table(spark, sf, n) for n in ("part", "nation", "region"))
    joined = part.join(nation, F.expr("n_nationkey = p_partkey % 25")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    url = PAGE_URL_SQL.replace(" // ", " div ")  # the integer division of Spark
    return joined.selectExpr("p_partkey as page_id", f"{url} as url", *[f"{e} as {n}" for n, e in PAGE_TEXTS.items()])


def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """page_id, url, html: markup with decoys in a script and a comment, an unclosed <b> and later copies. The narrow parts
    are spread first: a page takes half a millisecond to read, and a row group holds a million of them."""
    decoy = f'<strong class="{VALUE_CLASS}" itemprop="rooms">99 phòng</strong><b class="{PRICE_CLASS}">1 tỷ</b>'
    pieces = [
        F.lit(f"<!DOCTYPE html><html><head><title>tin</title><script>var t='{decoy}';</script></head>"),
        F.lit(f"<body><!-- {decoy} --><p><b>chưa đóng<p>"),
        *[_markup(f, F.col(f.name)) for f in listing_fields()],
        F.lit("</body></html>"),
    ]
    return spread(page_texts(spark, sf), "page_id").select("page_id", "url", F.concat(*pieces).alias("html"))


def index_pages(spark: SparkSession, sf: str) -> DataFrame:
    """page_id, url, html: 20 listing links per page among other links."""
    link = F.concat(F.lit('<li><a itemprop="item" href="/ban/'), F.col("p_partkey").cast("string"), F.lit('.htm">tin</a>'))
    links = table(spark, sf, "part").select(
        F.expr(f"p_partkey div {LISTINGS_PER_INDEX}").alias("page_id"), "p_partkey", link.alias("link")
    )
    grouped = (
        spread(links, "page_id")
        .groupBy("page_id")
        .agg(F.array_sort(F.collect_list(F.struct("p_partkey", "link"))).alias("links"))  # 20 at most
    )
    html = F.concat(
        F.lit('<html><a href="/khac">khác</a><a itemprop="item" href="https://quang-cao.example/">ad</a><ul>'),
        F.array_join("links.link", ""),
        F.lit('</ul><a itemprop="item" href="">trống</a><a itemprop="item">trống</a></html>'),
    )
    url = F.concat(F.lit(f"{INDEX_URL}?page="), F.col("page_id").cast("string"))
    return grouped.select("page_id", url.alias("url"), html.alias("html"))


