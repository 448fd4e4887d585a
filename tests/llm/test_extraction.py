"""Page text, and templates by recurrence."""

import pytest

from khodat.llm.common import stored
from khodat.llm.extraction import extract_text, read_page

PAGES = {
    "<div>a<b>b</b><br>c</div><p>d &amp; e&nbsp;f &#233;": "ab c\nd & e f é",
    "": "",
    "plain text < 3 & more <p cl": "plain text < 3 & more",
    "<nav><ul><li>x</ul><article><h1>T</h1><p>one<p>two<div class='ad'>no</div></article><aside>z</aside>": "T\none\ntwo",
    "<body><main><header><h1>T</h1></header><p>one <!-- x --> two</p><section class=comments><article><p>c</p></article></section>"
    "<form><input>no</form><script>if(a<b)document.write('</p>')</script><p>end</main><footer>f": "T\none two\nend",
    "<ARTICLE><P>Up &lt;b&gt; <Span>x</span><table><tr><td>1<td>2</table></ARTICLE>": "Up <b> x\n1\n2",
    "<p>a</p></div><p>b</p><style>x": "a\nb",
    "<article>t <p>u</p> v</article> w": "t\nu\nv",
    "<p title='a>b'>q</p><p title=\"it's\">r</p><p>x <a href='it's'>y</a></p>": "q\nr\nx y",
    "<html><head><title>no</title><meta charset=x></head><body class='has-sidebar'><p>yes</p><div id=cookie-notice>no</div><div role=banner>no</div>"
    "<ul class='main-menu'><li>no</ul><div class='reader comments'><p>no</div><p hidden>no</p><!-- unclosed <p>no</p>": "yes",
    "<article><p>one <span class='ad'>no</span> two</p><div><div class=adspace-ad>no<div>no</div></div>three</div></article>": "one two\nthree",
    "<div class='header'>x</div><p>" + "long " * 40_000 + "</p>": "x\n" + ("long " * 40_000).strip(),
}


@pytest.mark.parametrize("html", PAGES, ids=range(len(PAGES)))
def test_pages(html):
    assert "\n".join(read_page(html)[0]) == PAGES[html]


@pytest.mark.parametrize("other", [
    "<aside><article>teaser</article></aside>", "<div class=comments><article>said</article></div>", "<script>var a = '<article>';</script>",
    "<nav><main>x</main></nav>", "<article><img></article>",
])
def test_an_article_that_is_not_read_hides_nothing(other):
    for html in (f"<body>{other}<div class=content><p>Whole text</p></div></body>", f"<body><div class=content><p>Whole text</p></div>{other}</body>"):
        assert read_page(html)[0] == ["Whole text"]


@pytest.mark.parametrize("tag", [
    'div class="social-history"', 'p class="notice-of-motion"', 'section id="widget-theory"', 'div class="search-results-analysis"', 'div class="has-sidebar"',
])
def test_names_that_only_hold_a_dropped_word_drop_nothing(tag):
    part = f"<{tag}>Kept text</{tag.split()[0]}>"
    assert read_page(f"<article><p>One</p>{part}</article>")[0] == ["One", "Kept text"]
    assert read_page(f"<body>{part}<p>Two</p></body>")[0] == ["Kept text", "Two"]


@pytest.mark.parametrize("name", [
    "main-menu", "cookie-notice", "ad_box", "share-buttons", "related-posts", "sidebar-inner", "page__sidebar--open", "comment-list", "story comments",
])
def test_names_of_other_things_drop_them(name):
    for key in ("class", "id"):
        assert read_page(f"<article><p>One</p><div {key}='{name}'>no</div></article>")[0] == ["One"]


@pytest.mark.parametrize("cut", range(0, 120, 7))
def test_cut_pages_do_not_fail(cut):
    html = "<body><nav><a href='x'>m</a></nav><article><p class=\"a b\">One &amp; <b>two</b><script>var a='<p>';</script></p></article></body>"
    assert set("\n".join(read_page(html[:cut])[0])) <= set("One & two\nm&amp</")


def pages(spark, rows):
    return stored(spark.createDataFrame([(*r, "t", 1, None) for r in rows], "page_id long, url string, html string, text string, row int, blocks string").coalesce(3), "pages")


def test_what_recurs_on_a_host_goes(spark):
    box = "<div><b>About this site</b> and more</div>"
    rows = [(i, f"http://a.org/{i}", f"<body><p>Story {i}</p>{box if i % 2 else ''}<p>Said often</p></body>") for i in range(40)]
    rows += [(100 + i, f"http://b.org/{i}", f"<body><p>Other {i}</p>{box if i < 3 else ''}</body>") for i in range(12)]
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert all(got[i] == f"Story {i}" for i in range(40))
    assert all(got[100 + i] == f"Other {i}" + ("\nAbout this site and more" if i < 3 else "") for i in range(12))


def test_passages_in_articles_and_copies_of_pages_stay(spark):
    rows = [(i, f"http://a.org/{i}", f"<div>top</div><article><p>Story {i}</p><p>Passage of all</p><div>Sign up here</div></article>") for i in range(20)]
    rows += [(100 + i, f"http://c.org/{i}", "<body><div><p>A copied page</p></div></body>") for i in range(20)]
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert all(got[i] == f"Story {i}\nPassage of all" for i in range(20))
    assert all(got[100 + i] == "A copied page" for i in range(20))


def test_lists_and_short_passages_of_a_template_in_an_article_go(spark):
    share, rows = "<ul><li>Mail<li>Print</ul>", []
    for i in range(20):
        rows.append((i, f"http://a.org/{i}", f"<article><h1>Story {i}</h1>{share}<p>Text {i}</p><p>Said twice</p><p>More {i}</p><p>All rights kept</p></article>"))
        table = "<table><tr><td>Only<td>here</table>"
        rows += [(100 + 20 * k + i, f"http://b.org/{'xyzuv'[k]}/{i}", f"<article><p>Page {k} {i}</p>{'' if k else table}<p>End {k} {i}</p></article>") for k in range(5)]
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert all(got[i] == f"Story {i}\nText {i}\nSaid twice\nMore {i}" for i in range(20))
    # A title and what it announces stay, however many pages have them.
    rows = [(i, f"http://a.org/{i}", f"<article><h1>News</h1><p>News of today</p><p>Text {i}</p></article>") for i in range(20)]
    assert {r.text.replace(str(r.page_id), "") for r in extract_text(pages(spark, rows)).collect()} == {"News\nNews of today\nText "}
    assert all(got[100 + 20 * k + i] == f"Page {k} {i}\nEnd {k} {i}" for k in range(5) for i in range(20))


def test_odd_rows(spark):
    rows = [(1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (None, "x", None), (2, "http://a.org", ""), (3, "http://a.org", "<nav>x</nav>")]
    got = sorted(map(tuple, extract_text(pages(spark, rows)).collect()), key=str)
    assert got == sorted([(1, None, "a", 1)] * 2 + [(None, "x", "", 0), (2, "http://a.org", "", 0), (3, "http://a.org", "", 0)], key=str)
    assert extract_text(pages(spark, [])).collect() == []
