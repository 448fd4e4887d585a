"""Main text of pages: site templates are found by counting element subtrees per host, and removed.

Blocks of text are read with the hashes of the elements around them; hashes that recur across many different pages of a
host, or of a section of it, are its template, and blocks within them go. What an element's name, class, id or role
declares as something else than the article goes as it is read. Pages are read twice, once for the hashes and once for
the blocks, so that the text is written only once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khodat.llm.common import stored, text_chunks
from khodat.llm.url_rules import host_and_path

#: A subtree is template if it stands in so many different pages of a host or section, and in this share of them.
MIN_PAGES = 8
MIN_SHARE = 0.3
#: Code points up to which a passage in a declared article can be template by its place.
SHORT = 200

# Elements and names that hold no article text (fixed values).
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas select xmp noembed noframes".split())
DROPPED = frozenset("nav header footer aside form button dialog menu fieldset audio video map datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr output q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main"))
WHOLE = ARTICLE | {"html", "body"}
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsbygoogle adslot sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay sidebar menu nav navbar navigation navi breadcrumb breadcrumbs comment "
    "comments commentlist disqus respond replies share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login footer masthead toolbar pagination pager widget widgets topbar search form paywall".split()
)
# Words behind such a name that say what kind of box it is or how it is shown, and words before it that say what something else has.
BOX_WORDS = frozenset(
    "area articles bar block body bottom box button buttons card cards closed col column container content fixed form group header "
    "heading holder icon icons inner item items label large layer layout left link links list main message mobile module open outer panel "
    "placeholder post posts primary region results right root row section slot small space stories story strip tab tabs text thread "
    "title toggle top unit videos view visible wrap wrapper zone".split()
)
HAVING_WORDS = frozenset("has with without no".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# Elements that hold text directly.
TEXT_ELEMENTS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr table tbody ul ol dl figcaption caption".split())
# Those of them that hold a single passage.
PASSAGES = TEXT_ELEMENTS - {"table", "tbody", "ul", "ol", "dl"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Items that end before the next one of their kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TAG = re.compile(
    r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)"""
    # A quote counts only behind an equals sign, and only if it is closed.
    r"""|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>[^>=]*+(?:=\s*+(?:"[^"]*"|'[^']*'|)[^>=]*+)*+)>"""
    r"""|[!?/][^>]*(?:>|\Z)|[a-zA-Z][^<>]*(?:\Z|(?=<)))""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_PARTS = re.compile(r"[^a-z]+")


@dataclass
class Element:
    name: str
    first: int
    digest: xxhash.xxh64 = field(default_factory=xxhash.xxh64)
    #: Of each child with text its name, hash, first block and the one behind it; the name of bare text is empty.
    children: list[tuple[str, int, int, int]] = field(default_factory=list)


def declared_otherwise(name: str, rest: str, inside: bool) -> bool:
    """Whether an element says by its name, class, id or role that it is no article text. A header inside an article may hold its
    title, and what holds the whole page is judged by name alone."""
    if name in DROPPED and not (inside and name == "header"):
        return True
    if not rest or name in WHOLE:
        return False
    for key, value in ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in DROPPED_ROLES:
            return True
        if key in ("class", "id") and any(named_otherwise(token) for token in value.split()):
            return True
    return False


def named_otherwise(token: str) -> bool:
    """Whether a class or id names something that is no article text: by its head, the last word that isn't of the kind of
    ``BOX_WORDS``. So main-menu and ad-box do, while social-history, notice-of-motion and has-sidebar say what a text is about or has."""
    if DROPPED_NAMES.isdisjoint(parts := [p for p in NAME_PARTS.split(token) if p]):
        return False
    while parts[-1] not in DROPPED_NAMES and parts[-1] in BOX_WORDS:
        parts.pop()
    return parts[-1] in DROPPED_NAMES and HAVING_WORDS.isdisjoint(parts[:-1])


def signed(value: int) -> int:
    return value - ((value >> 63) << 64)


def places(parent: Element, sizes: list[int]) -> list[tuple[int, int, int]]:
    """Hashes of short passages in a declared article by their place, with the blocks they cover: two that follow each other,
    with their number from the first or the last child, and the one at either end of a parent that is no list or table. A
    heading that opens its parent is a title: it is no template, and what follows it is not at an end."""
    found, children = [], parent.children
    short = [name in PASSAGES and sum(sizes[first:behind]) <= SHORT for name, _, first, behind in children]
    if children and children[0][0] in HEADINGS:
        short[0] = False

    def add(place: str, *those: tuple[str, int, int, int]) -> None:
        named = f"{parent.name} {place} " + " ".join(str(value) for _, value, _, _ in those)
        found.append((signed(xxhash.xxh64_intdigest(named)), those[0][2], those[-1][3]))

    for i in range(len(children) - 1):
        if short[i] and short[i + 1]:
            add(f"+{i}", *children[i : i + 2])
            add(f"-{len(children) - i}", *children[i : i + 2])
    if children and parent.name not in TEXT_ELEMENTS:
        if short[0]:
            add("first", children[0])
        if short[-1]:
            add("last", children[-1])
    return found


def resumes(tag: re.Match) -> bool:
    """Whether an element that lacks its end is over here at the latest."""
    name = (tag["name"] or "").lower()
    return name in ("article", "main") or not tag["end"] and name in ("footer", "body")


def read_page(html: str) -> tuple[list[str], list[list[int]], list[int]]:
    """Blocks of the article in page order, for each the hashes of the elements around it, and the hashes of all elements of
    the page that can be template.

    The article is what stands in article or main elements; in a page where none of them was entered and gave text it is the
    whole body. In a declared article a passage (paragraph, heading, item) is no template by its content alone, since sites
    repeat passages, but with its place (see ``places``); in other pages every element can be. A hash covers name and
    content of the subtree. Bad markup is read as browsers do: end tags without a start are
    skipped, an end tag closes what is open inside, blocks end a paragraph, a tag cut off by the end of the page is none. An
    element to be dropped that is never closed ends before the next article, main or footer.
    """
    tags = list(TAG.finditer(html))
    last_end: dict[str, int] = {}
    for i, tag in enumerate(tags):
        if tag["end"]:
            last_end[tag["name"].lower()] = i
    blocks: list[tuple[str, bool]] = []  # with whether it stands in the article
    around: list[tuple[int, int, int]] = []  # subtree hash with the first block in it and the one behind it
    passages: list[tuple[int, int, int]] = []  # the same of what counts in pages without article only
    parents: list[Element] = []  # elements in or of the article
    stack: list[Element] = []
    run: list[str] = []
    depth_article, at, i = 0, 0, 0

    def finish_block() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            if stack:
                stack[-1].digest.update(text)
                stack[-1].children.append(("", 0, len(blocks), len(blocks) + 1))
            blocks.append((text, depth_article > 0))

    def close(upto: int) -> None:
        nonlocal depth_article
        while len(stack) > upto:
            finish_block()
            element = stack.pop()
            if depth_article and len(blocks) > element.first:
                parents.append(element)
            if element.name in ARTICLE:
                depth_article -= 1
            element.digest.update("\0" + element.name)
            value = element.digest.intdigest()
            if stack:
                stack[-1].digest.update(value.to_bytes(8, "big"))
                if len(blocks) > element.first:
                    stack[-1].children.append((element.name, value, element.first, len(blocks)))
            if element.name not in WHOLE:
                (passages if element.name in PASSAGES else around).append((signed(value), element.first, len(blocks)))

    while i < len(tags):
        tag = tags[i]
        if tag.start() > at:
            run.append(unescape(html[at : tag.start()]) if "&" in html[at : tag.start()] else html[at : tag.start()])
        at = max(at, tag.end())
        i += 1
        name = tag["name"]
        if not name:
            continue
        name = name.lower()
        if tag["end"]:
            if name in INLINE:
                continue
            for up in range(len(stack) - 1, -1, -1):
                if stack[up].name == name:
                    close(up)
                    break
            else:
                finish_block()
            continue
        if name in RAW:
            if tag["rest"].endswith("/") and name in ("svg", "math"):
                continue
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, tag.end())
            at = end.end() if end else len(html)
            while i < len(tags) and tags[i].start() < at:
                i += 1
            continue
        if name in INLINE and not declared_otherwise(name, tag["rest"], depth_article > 0):
            if name == "br":
                run.append(" ")
            continue
        if name in VOID:
            finish_block()
            continue
        if name == "head" or declared_otherwise(name, tag["rest"], depth_article > 0):
            if name not in INLINE:
                finish_block()
            # Skip to the end tag that belongs to it; without one, to where the article or the footer begins.
            level, j = 1, i
            if last_end.get(name, -1) >= i:
                while j < len(tags):
                    if (other := tags[j]["name"]) and other.lower() == name:
                        level += -1 if tags[j]["end"] else 1
                        if not level:
                            break
                    j += 1
            if level:
                j = i
                while j < len(tags) and not resumes(tags[j]):
                    j += 1
                at, i = (tags[j].start(), j) if j < len(tags) else (len(html), j)
            else:
                at, i = tags[j].end(), j + 1
            continue
        finish_block()
        if stack and stack[-1].name == "p":
            close(len(stack) - 1)
        for other in CLOSES.get(name, ()):
            if stack and stack[-1].name == other:
                close(len(stack) - 1)
        if name in ARTICLE:
            depth_article += 1
        if not tag["rest"].endswith("/") or name in ("p", "div"):
            stack.append(Element(name, len(blocks)))
    if at < len(html):
        run.append(unescape(html[at:]))
    close(0)
    finish_block()
    has_article = any(inside for _, inside in blocks)
    sizes = [len(b) for b, _ in blocks]
    around += [a for e in parents for a in places(e, sizes)] if has_article else passages
    owns: list[list[int]] = [[] for _ in blocks]
    for value, first, behind in around:
        for own in owns[first:behind]:
            own.append(value)
    kept = [i for i, (_, inside) in enumerate(blocks) if inside or not has_article]
    return [blocks[i][0] for i in kept], [owns[i] for i in kept], [value for value, _, _ in around]


def read_pages(pages: DataFrame) -> DataFrame:
    """Every row of ``pages`` (page_id, url, html) read: page_id, url, key, host, section, blocks, hashes, and a digest of the
    blocks. Rows of one key are alike in all of these. The section is the first folder of the path."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64()))]))
        for chunk in text_chunks(batches, "html", 2 << 20):
            found = [read_page(h or "") for h in chunk.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                **{c: chunk.column(c) for c in ("page_id", "url", "host", "section")},
                "blocks": pa.array([[{"text": t, "around": a} for t, a in zip(b, own)] for b, own, _ in found], kind),
                "hashes": pa.array([list(dict.fromkeys(h)) for _, _, h in found], pa.list_(pa.int64())),
                "digest": pa.array([xxhash.xxh64_intdigest("\n".join(b)) - (1 << 63) for b, _, _ in found], pa.int64()),
            })

    host, path = host_and_path(F.col("url"))
    return pages.select("page_id", "url", "html", host.alias("host"), F.regexp_extract(path, "^/+([^/]+)/", 1).alias("section")).mapInArrow(
        read, "page_id long, url string, host string, section string, blocks array<struct<text string, around array<bigint>>>, "
        "hashes array<bigint>, digest long",
    ).withColumn("key", F.xxhash64("page_id", "url", "digest", "hashes"))


def templates(read: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Hashes (place, hash) that recur in at least ``min_pages`` pages of a place and ``min_share`` of them. Pages of equal text
    count as one: copies of a page do not make its article a template."""
    seen = (
        read.select("place", "digest", F.explode("hashes").alias("hash")).distinct()
        .groupBy("place", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    )
    sizes = read.select("place", "digest").distinct().groupBy("place").agg(F.count("*").alias("pages"))
    return seen.join(sizes, "place").where(F.col("n") >= min_share * F.col("pages")).select("place", "hash")


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    Blocks are joined by one line break; white space inside a block is one space. Null or empty html, and pages without
    article text, give the empty text. A null url has the empty host. Repeated rows stay; an empty table gives no rows.
    """
    read = read_pages(pages)
    # A page counts for its host and, if it has one, for its section there.
    section = F.when(F.col("section") != "", F.xxhash64("host", "section"))
    placed = stored(
        read.select(
            "key", "digest", "hashes", F.explode(F.array_compact(F.array(F.xxhash64("host"), section))).alias("place"),
        ), "page-hashes",
    )
    removed = (
        placed.select("key", "place", F.explode("hashes").alias("hash"))
        .join(templates(placed, min_pages, min_share), ["place", "hash"]).groupBy("key").agg(F.collect_set("hash").alias("removed"))
    )
    kept = F.filter("blocks", lambda b: F.col("removed").isNull() | ~F.arrays_overlap(b["around"], "removed"))
    return (
        read.select("page_id", "url", "blocks", "key").join(removed, "key", "left").withColumn("blocks", kept)
        .select("page_id", "url", F.array_join("blocks.text", "\n").alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
    )
