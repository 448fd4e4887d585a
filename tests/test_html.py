"""Page reading: first match, nesting, broken markup, and the quick tokeniser against the standard parser."""

import subprocess
import sys
from functools import partial

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark import cloudpickle
from pyspark.sql import functions as F

from khodat.checks import data
from khodat.plans.ingest import listing_ingest, listing_links
from khodat.sources.html import (
    HOUSE_TYPE, LOCATION_CLASS, PRICE_CLASS, PROJECT_CLASS, VALUE_CLASS, Field, _AllFound, _AnyPage, _Fields, _Links,
    _read_quickly, extract_fields, extract_links, irregular_pages, listing_fields, read_page,
)


def value(itemprop, text, css=VALUE_CLASS):
    return f'<strong class="{css}" itemprop="{itemprop}">{text}</strong>'


def one(page, field):
    return read_page(page, partial(_Fields, (field,)))[0]


ROOMS = Field("room", "strong", VALUE_CLASS, "rooms")


def test_first_match_wins_and_missing_is_none():
    assert one(value("rooms", "3 phòng") + value("rooms", "9"), ROOMS) == "3 phòng"
    assert one(value("toilets", "3 phòng"), ROOMS) is None
    assert one(value("rooms", ""), ROOMS) == ""


def test_class_is_one_of_several_or_the_whole_attribute():
    assert one('<strong class="a b" itemprop="x">1</strong>', Field("f", "strong", "b")) == "1"
    assert one(f'<span class="{LOCATION_CLASS}">1</span>', Field("f", "span", LOCATION_CLASS)) == "1"
    assert one('<span class="flex-1 bwq0cbs">1</span>', Field("f", "span", LOCATION_CLASS)) is None
    assert one("<B CLASS=pyhk1dv>1 tỷ</B>", Field("f", "b", PRICE_CLASS)) == "1 tỷ"


def test_text_of_nested_and_unclosed_elements():
    assert one(value("rooms", "a<i>b</i><br>c<!-- d -->e"), ROOMS) == "abce"
    assert one("<div>" + value("rooms", "a<b>b").removesuffix("</strong>") + "</div>c", ROOMS) == "ab"
    assert one(value("rooms", "a</p>b"), ROOMS) == "ab"
    assert one(value("rooms", "a<strong>b</strong>c"), ROOMS) == "abc"
    assert one(value("rooms", "&lt;3 &amp; 4&gt;"), ROOMS) == "<3 & 4>"


def test_markup_in_scripts_and_comments_does_not_count():
    decoy = value("rooms", "99")
    assert one(f"<script>var t='{decoy}';</script><!-- {decoy} -->" + value("rooms", "1"), ROOMS) == "1"
    assert one(value("rooms", "1<script>x</script>2"), ROOMS) == "12"


def test_inner_tag():
    project = listing_fields()[0]
    assert one(f'<span class="{PROJECT_CLASS}" itemprop="new_project">x<a><i>P</i> Q</a></span>', project) == "P Q"
    assert one(f'<span class="{PROJECT_CLASS}" itemprop="new_project">x</span><a>y</a>', project) is None


def test_text_is_composed():
    assert one(value("rooms", "tồ"), ROOMS) == "tồ"


def test_irregular_pages_go_through_the_standard_parser():
    assert one("a < b <p title=it's>" + value("rooms", "1"), ROOMS) == "1"
    assert one("<!-- a -- b -->" + value("rooms", "1"), ROOMS) == "1"
    assert one("<?php ?><a / b>" + value("rooms", "1 <"), ROOMS) == "1 <"


def by_standard_parser(page, reader):
    try:
        parser = _AnyPage(reader)
        parser.feed(page)
        parser.close()
        reader.end_of_page()
    except _AllFound:
        pass
    return reader.result


PIECES = st.lists(
    st.sampled_from([
        "<b>", "</b>", "<b class=x>", "<i itemprop='p q'>", "</i>", "<br>", "<br/>", "<i/>", "<B Class='x y' >", "</B >",
        "<script>", "</script>", "<script>var a='<b class=x>';</script>", "<style>p{}</style>", "<!-- c -->",
        "<!-- <b class=x> -->", "<!---->", "<!doctype html>", "text", " ", "\n", "&amp;", "&lt", "&#x27;", "<", ">", "=",
        '"', "<a href=/x/>", '<a href="https://y">', '<a itemprop="item" href="/z?a=1&amp;b=2">', "<a href>", "</a>",
        "<p title=it's>", "</p>", "<template>", "</template>", "<div>", "</div>", "<b class=x>y</b>", "<bb class=x>", "<scripty>", "<b class=x class=z>", "<title>", "</title>", "--", "-->", "<!", "</", "/>", "é",
    ]),
    max_size=30,
).map("".join)


@settings(max_examples=3000, deadline=None)
@given(PIECES)
def test_both_tokenisers_agree(page):
    fields = (Field("b", "b", "x"), Field("i", "i", None, "p q"), Field("t", "title"), Field("n", "i", inner="b"))
    assert read_page(page, partial(_Fields, fields)) == by_standard_parser(page, _Fields(fields))
    for itemprop in (None, "item"):
        assert read_page(page, partial(_Links, itemprop)) == by_standard_parser(page, _Links(itemprop))


def test_most_pages_are_read_by_jumping():
    fields = (ROOMS,)
    page = "<div><p>x<b>y<br>" + value("rooms", "1 <i>a</i>") + "</div><script>var a='<b>';</script>"
    assert _read_quickly(page + "<!-- c -->", _Fields(fields + (Field("z", "em"),), True))
    # The end tag may belong to an element around the one being read.
    assert not _read_quickly("<div>" + value("rooms", "1</div>"), _Fields(fields, True))
    assert not _read_quickly("<template>" + value("rooms", "1"), _Fields(fields, True))


def test_pages_for_the_standard_parser_are_counted(spark):
    good, bad = "<div>" + value("rooms", "1") + "</div>", "<div>" + value("rooms", "1</div>")
    pages = spark.createDataFrame([(good,), (bad,), (None,), (good + "<",), ("<p>x",)], "html string")
    assert tuple(irregular_pages(pages, (ROOMS, Field("z", "em"))).first()) == (5, 2)


def listing_html(type_itemprop="apartment_type"):
    return (
        f'<span class="{PROJECT_CLASS}" itemprop="new_project"><a>Dự án X</a></span>'
        f'<b class="{PRICE_CLASS}">5,2 tỷ</b><span class="{LOCATION_CLASS}">Phường A, Quận B</span>'
        + value("size", "62,5 m²") + value("price_m2", "1,2 tỷ/m²") + value("rooms", "nhiều hơn 6")
        + value("toilets", "không") + value("floors", "12") + value(type_itemprop, "Chung cư")
    )


def test_listing_rows(spark):
    pages = spark.createDataFrame([("u/1", listing_html()), ("u/2", None), ("u/3", "<p>")], "url string, html string")
    rows = {r.url: r for r in listing_ingest(pages).collect()}
    first = rows["u/1"]
    assert (first.du_an, first.price_VND, first.area, first.price_m2) == ("Dự án X", 5.2, 62.5, 1200.0)
    assert (first.room, first.toilet, first["Số tầng"], first.type, first.status) == (6, None, 12, "Chung cư", None)
    for url in ("u/2", "u/3"):
        assert all(v is None for k, v in rows[url].asDict().items() if k != "url")


def test_readers_need_no_installed_package():
    """What goes to the workers is read back by an interpreter that cannot find this package."""
    payload = cloudpickle.dumps((read_page, partial(_Fields, (ROOMS,)), partial(_Links, None), value("rooms", "3")))
    program = (
        "import pickle, sys; read, fields, links, page = pickle.load(sys.stdin.buffer); "
        "print(read(page, fields), read('<a href=/1>', links), read('a < ' + page, fields))"
    )
    out = subprocess.run([sys.executable, "-c", program], input=payload, capture_output=True, cwd="/")
    assert out.stdout.decode().strip() == "['3'] ['/1'] ['3']", out.stderr.decode()


def test_house_type_is_a_parameter(spark):
    pages = spark.createDataFrame([("u", listing_html("house_type"))], "url string, html string")
    assert listing_ingest(pages, type_itemprop=HOUSE_TYPE).first().type == "Chung cư"
    assert listing_ingest(pages).first().type is None


def test_links(spark):
    html = '<a itemprop="item" href="/1">x</a><a itemprop=item href="https://ad">y</a><a href="/2"><a itemprop="item" href="">'
    pages = spark.createDataFrame([("http://h/q?page=7", html), ("n", None)], "url string, html string")
    assert [tuple(r) for r in extract_links(pages).collect()] == [("http://h/q?page=7", 0, "/1")]
    assert listing_links(pages).first().link == "http://h/q7/1"


def test_other_columns_stay(spark):
    pages = spark.createDataFrame([(1, "<h1>a</h1>", "k")], "page_id int, html string, note string")
    assert extract_fields(pages, (Field("h", "h1"),)).first().asDict() == {"page_id": 1, "note": "k", "h": "a"}


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_pages_made_of_one_row_group_are_read_by_many_tasks(spark):
    found = rows_by_task(extract_fields(data.listing_pages(spark, "/root/testdata/sf0.001"), listing_fields()))
    assert sum(found) == 200 and len(found) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(found) < 60


def test_index_pages_are_read_by_many_tasks(spark):
    # Ten pages only, so some tasks may get none.
    found = rows_by_task(data.index_pages(spark, "/root/testdata/sf0.001").select("page_id"))
    assert sum(found) == 10 and len(found) > 2
