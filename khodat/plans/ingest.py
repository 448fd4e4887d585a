"""Listing pages to typed listing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khodat.functions import parsing as P
from khodat.sources.html import APARTMENT_TYPE, extract_fields, extract_links, listing_fields


def normalize_listing(texts: DataFrame) -> DataFrame:
    """The crawled columns with numbers read from their texts; other columns of ``texts`` come first."""
    fields = [f.name for f in listing_fields()]
    return texts.select(
        *[c for c in texts.columns if c not in fields],
        P.strip_boilerplate("du_an").alias("du_an"),
        P.normalize_price("price").alias("price_VND"),
        "location",
        "status",
        P.parse_area("area").alias("area"),
        P.normalize_price_m2("price_m2").alias("price_m2"),
        P.first_integer("toilet").alias("toilet"),
        P.first_integer("room").alias("room"),
        "doc",
        "type",
        P.parse_floor("floor").alias("Số tầng"),
        "furnishing",
    )


def listing_links(index_pages: DataFrame, url: str = "url") -> DataFrame:
    """Address of every listing an index page links to."""
    links = extract_links(index_pages)
    return links.select(*links.columns, P.resolve_link(url, "href").alias("link"))


def listing_ingest(
    pages: DataFrame, index_pages: DataFrame | None = None, type_itemprop: str = APARTMENT_TYPE
) -> DataFrame:
    """Listing rows of the crawled pages; with index pages, one row per link those hold.

    ``pages`` holds url and html. Each page is read once, where it lies: only the short rows are joined with the
    links, never the page text.
    """
    rows = normalize_listing(extract_fields(pages, listing_fields(type_itemprop)))
    if index_pages is None:
        return rows
    links = listing_links(index_pages).select(F.col("link").alias("url"))
    return links.join(rows, "url").select(*rows.columns)
