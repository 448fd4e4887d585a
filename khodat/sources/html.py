"""Fields and links of listing pages.

Malformed markup rules out extracting by pattern in the JVM, so pages are tokenised in Arrow batches. Only the page
text goes to the Python workers; the other columns stay in the JVM.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """The first ``tag`` with the given class and itemprop; its text, or that of the first ``inner`` tag in it."""

    name: str
    tag: str
    css_class: str | None = None
    itemprop: str | None = None
    inner: str | None = None

    def has_class(self, attrs: dict[str, str | None]) -> bool:
        if self.css_class is None:
            return True
        given = attrs.get("class") or ""
        if given == self.css_class:
            return True
        classes = given.split()
        return self.css_class in classes or self.css_class == " ".join(classes)


# Class names and itemprops of the listing markup.
VALUE_CLASS = "AdParam_adParamValuePty__3uTmt"
PROJECT_CLASS = "AdParam_adParamValue__IfaYa"
LOCATION_CLASS = "bwq0cbs flex-1"
PRICE_CLASS = "pyhk1dv"
APARTMENT_TYPE = "apartment_type"
HOUSE_TYPE = "house_type"


def listing_fields(type_itemprop: str = APARTMENT_TYPE) -> tuple[Field, ...]:
    """The twelve fields of a listing page; houses use HOUSE_TYPE."""

    def value(name: str, itemprop: str) -> Field:
        return Field(name, "strong", VALUE_CLASS, itemprop)

    return (
        Field("du_an", "span", PROJECT_CLASS, "new_project", inner="a"),
        Field("price", "b", PRICE_CLASS),
        Field("location", "span", LOCATION_CLASS),
        value("status", "property_status"),
        value("area", "size"),
        value("price_m2", "price_m2"),
        value("toilet", "toilets"),
        value("room", "rooms"),
        value("doc", "property_legal_document"),
        value("type", type_itemprop),
        value("floor", "floors"),
        value("furnishing", "furnishing_sell"),
    )


# Elements without content, and elements whose text is not part of the page text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset(("script", "style", "template"))

_TAG = "[a-z][a-z0-9:-]*+"
_NAME = r"""[^\s"'<>/=]++"""
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'=<>`]++)"""
_ATTRIBUTES = rf"(?:\s++{_NAME}(?:\s*+=\s*+{_VALUE})?+)*+"
_ATTRIBUTE = re.compile(rf"\s++({_NAME})(?:\s*+=\s*+({_VALUE}))?+")
_ASIDE = r"<!--(?!>|->)(?:[^-]|-(?!-))*+-->|<!doctype[^>]*+>"
_FLAGS = re.IGNORECASE | re.DOTALL
# Text up to the next tag, then one of: end tag, script or style with its content, start tag, comment or
# doctype, end of the page.
_TOKEN = re.compile(
    rf"([^<]*+)(?:</({_TAG})\s*+>|<(script|style)({_ATTRIBUTES})\s*+>.*?</\3\s*+>"
    rf"|<(?!script|style)({_TAG})({_ATTRIBUTES})\s*+(/?)>|{_ASIDE}|\Z)",
    _FLAGS,
)


_patterns: dict[frozenset[str], re.Pattern] = {}


def _before(tags: frozenset[str]) -> re.Pattern:
    """Everything up to the next start tag among ``tags``, or to one that needs a closer look."""
    if tags not in _patterns:
        stops = "|".join(["script", "style", "template", *(re.escape(t) + "(?![a-z0-9:-])" for t in sorted(tags))])
        _patterns[tags] = re.compile(
            rf"(?:[^<]++|</{_TAG}\s*+>|<(?!{stops}){_TAG}{_ATTRIBUTES}\s*+/?>"
            rf"|<script{_ATTRIBUTES}\s*+>.*?</script\s*+>|<style{_ATTRIBUTES}\s*+>.*?</style\s*+>|{_ASIDE})*+",
            _FLAGS,
        )
    return _patterns[tags]


def _attributes(attrs: str | list) -> dict[str, str | None]:
    if isinstance(attrs, list):
        return dict(attrs)
    found = {}
    for name, value in _ATTRIBUTE.findall(attrs):
        if value[:1] in ('"', "'"):
            value = value[1:-1]
        found[name.lower()] = unescape(value)
    return found


class _AllFound(Exception):
    pass


class _Fields:
    """Collects the wanted texts; an end tag closes everything opened since its start tag.

    ``skipping`` says that the reader gets no tags outside the elements it reads, so that it cannot know what
    encloses them.
    """

    def __init__(self, fields: Sequence[Field], skipping: bool = False):
        self.result: list[str | None] = [None] * len(fields)
        self._skipping = skipping
        self._fields = fields
        # Tag -> itemprop (None for any) -> fields.
        self._wanted: dict[str, dict[str | None, list[int]]] = {}
        for i, field in enumerate(fields):
            self._wanted.setdefault(field.tag, {}).setdefault(field.itemprop, []).append(i)
        # Start tags that matter while nothing is being read.
        self.tags = frozenset(self._wanted)
        self._awaiting_inner: dict[int, str] = {}
        # Open elements as (tag, fields reading their text from it, fields looking for an inner tag in it).
        self._open: list[tuple[str, list[int], list[int]]] = []
        self._n_open: dict[str, int] = {}
        self._texts: dict[int, list[str]] = {}
        self._hidden = 0

    def start(self, tag: str, attrs: str | list, closed: bool = False) -> None:
        reading, waiting = (), ()
        if self._awaiting_inner or tag in self._wanted:
            reading, waiting = self._look(tag, attrs)
        if closed or tag in _VOID:
            if reading or waiting:
                self._finish(reading, waiting)
            return
        if self._skipping and not (self._open or reading or waiting):
            return
        if tag in _HIDDEN:
            self._hidden += 1
        self._open.append((tag, reading, waiting))
        self._n_open[tag] = self._n_open.get(tag, 0) + 1

    def _look(self, tag: str, attrs: str | list) -> tuple[list[int], list[int]]:
        reading, waiting = [], []
        for i in [i for i, inner in self._awaiting_inner.items() if inner == tag]:
            del self._awaiting_inner[i]
            reading.append(i)
        if tag in self._wanted:
            self._look_for_fields(tag, _attributes(attrs), reading, waiting)
        for i in reading:
            self._texts[i] = []
        return reading, waiting

    def _look_for_fields(self, tag: str, attrs: dict, reading: list[int], waiting: list[int]) -> None:
        by_itemprop = self._wanted[tag]
        for itemprop in {attrs.get("itemprop"), None}:
            missing = by_itemprop.get(itemprop, ())
            found = [i for i in missing if self._fields[i].has_class(attrs)]
            if not found:
                continue
            for i in found:
                missing.remove(i)
                inner = self._fields[i].inner
                if inner is None:
                    reading.append(i)
                else:
                    self._awaiting_inner[i] = inner
                    waiting.append(i)
            if not missing:
                del by_itemprop[itemprop]
        if not by_itemprop:
            del self._wanted[tag]
            self.tags = frozenset(self._wanted)

    def end(self, tag: str) -> bool:
        """False if the tag may close an element the reader has not been told of."""
        if not self._n_open.get(tag):
            return not self._skipping
        name = None
        while name != tag:
            name, reading, waiting = self._open.pop()
            self._n_open[name] -= 1
            if name in _HIDDEN:
                self._hidden -= 1
            if reading or waiting:
                self._finish(reading, waiting)
        return True

    def idle(self) -> bool:
        return not self._open

    def text(self, data: str) -> None:
        if self._texts and not self._hidden:
            for parts in self._texts.values():
                parts.append(data)

    def end_of_page(self) -> None:
        while self._open:
            self.end(self._open[-1][0])

    def _finish(self, reading: Sequence[int], waiting: Sequence[int]) -> None:
        for i in reading:
            self.result[i] = unicodedata.normalize("NFC", "".join(self._texts.pop(i)))
        for i in waiting:
            self._awaiting_inner.pop(i, None)
        if not (self._wanted or self._texts or self._awaiting_inner):
            raise _AllFound


class _Links:
    """Collects the hrefs of links."""

    def __init__(self, itemprop: str | None, skipping: bool = False):
        self.result: list[str] = []
        self.tags = frozenset("a")
        self._itemprop = itemprop

    def start(self, tag: str, attrs: str | list, closed: bool = False) -> None:
        if tag == "a":
            lookup = _attributes(attrs)
            href = lookup.get("href")
            if href and not href.startswith("https") and self._itemprop in (None, lookup.get("itemprop")):
                self.result.append(href)

    def end(self, tag: str) -> bool:
        return True

    def idle(self) -> bool:
        return True

    def text(self, data: str) -> None:
        pass

    def end_of_page(self) -> None:
        pass


class _AnyPage(HTMLParser):
    """Feeds a reader from a page of whatever shape."""

    def __init__(self, reader: _Fields | _Links):
        super().__init__(convert_charrefs=True)
        self._reader = reader
        self.handle_endtag = reader.end
        self.handle_data = reader.text

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._reader.start(tag, attrs)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self._reader.start(tag, attrs, closed=True)


def _read_element(page: str, reader: _Fields | _Links, position: int, first: frozenset[str]) -> int:
    """Feeds a reader tag by tag, from one of the start tags ``first`` until the reader is idle; returns where that is,
    -1 at a tag that is not well formed or not expected."""
    start, end, text, wanted = reader.start, reader.end, reader.text, first
    for token in _TOKEN.finditer(page, position):
        if token.start() != position:
            return -1
        position = token.end()
        data, closing, raw, raw_attrs, opening, attrs, slash = token.groups()
        if data:
            text(unescape(data) if "&" in data else data)
        if closing:
            if not end(closing.lower()):
                return -1
        elif opening:
            opening = opening.lower()
            if wanted is not None and opening not in wanted:
                return -1
            start(opening, attrs, bool(slash))
        elif raw:
            start(raw.lower(), raw_attrs, True)
        if reader.idle():
            return position
        wanted = None
    return position if position == len(page) else -1


def _read_quickly(page: str, reader: _Fields | _Links) -> bool:
    """Feeds a reader the elements it wants and passes over the rest in one match; False where that is unsafe: a tag is not
    well formed, or an element may be closed by one that encloses it."""
    position = 0
    while position >= 0:
        tags = reader.tags
        if tags & _HIDDEN:
            return False
        position = _before(tags).match(page, position).end()
        if position == len(page):
            return True
        position = _read_element(page, reader, position, tags)
    return False


def read_page(page: str, make_reader) -> list:
    """What a reader finds in a page; ``make_reader(skipping)`` gives a new one.

    The quick reader jumps from one wanted tag to the next; pages it can't decide go to the standard parser, some ten
    times slower.
    """
    try:
        reader = make_reader(True)
        if not _read_quickly(page, reader):
            reader = make_reader(False)
            parser = _AnyPage(reader)
            parser.feed(page)
            parser.close()
        reader.end_of_page()
    except _AllFound:
        pass
    return reader.result


def irregular_pages(pages: DataFrame, fields: Sequence[Field], html: str = "html") -> DataFrame:
    """How many pages there are, and how many of them need the standard parser to find the fields."""

    @F.pandas_udf(T.BooleanType())
    def irregular(batch: pd.Series) -> pd.Series:
        def one(page: str | None) -> bool:
            try:
                return page is not None and not _read_quickly(page, _Fields(fields, True))
            except _AllFound:
                return False

        return pd.Series([one(p) for p in batch], dtype=bool)

    return pages.agg(F.count(F.lit(1)).alias("n_pages"), F.count(F.when(irregular(html), 1)).alias("n_irregular"))


def field_struct(html: Column | str, fields: Sequence[Field]) -> Column:
    """Struct of the fields' texts, NULL where the page lacks the element; one pass per page."""
    names = [f.name for f in fields]
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])

    @F.pandas_udf(schema)
    def read(pages: pd.Series) -> pd.DataFrame:
        rows = [[None] * len(names) if p is None else read_page(p, partial(_Fields, fields)) for p in pages]
        return pd.DataFrame(rows, columns=names, dtype=object)

    return read(html)


def extract_fields(pages: DataFrame, fields: Sequence[Field], html: str = "html") -> DataFrame:
    """The other columns of ``pages`` followed by one column per field."""
    others = [c for c in pages.columns if c != html]
    return pages.withColumn("_fields", field_struct(html, fields)).select(*others, "_fields.*")


def extract_links(pages: DataFrame, itemprop: str | None = "item", html: str = "html") -> DataFrame:
    """One row per link of a page: position and href, leaving out empty ones and those starting with https."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def links(batch: pd.Series) -> pd.Series:
        return pd.Series([[] if p is None else read_page(p, partial(_Links, itemprop)) for p in batch], dtype=object)

    others = [c for c in pages.columns if c != html]
    return pages.select(*others, F.posexplode(links(html)).alias("pos", "href"))


# The readers travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
