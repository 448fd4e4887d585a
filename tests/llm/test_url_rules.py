"""URL parts, site rules and mined rules."""

import re
from itertools import combinations

from pyspark.sql import functions as F

from khodat.llm.queries import SITE_RULES
from khodat.llm.url_rules import all_tokens, host_and_path, judge_urls, match_rules, mine_rules, url_tokens

URLS = [
    None, "", "no scheme/path", "http://", "://", "HTTP://WWW.Example.ORG", "http://example.org/en/1?x#y", "http://a.example.org/es/",
    "http://example.org?x=/es/", "http://example.org#/es/", "http://notexample.org/es/", "http://xorg/", "http://É.org/ä", "a://b://c.com/fr/x",
    "https://example.com/de/", "https://example.com/fr/", "https://com/fr/1", "https://example.net:80/x.html?b=1&a=2#z", "http://example.org/en/", "http://x.org",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lowered, re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(url):
    host, path = parts(url)
    fits = [(len(h + p), h + p, v) for v, h, p in SITE_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_every_url_gets_its_parts_and_its_rule(spark):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, verdict string")
    rows = judge_urls(pages, spark.createDataFrame([], "url string, verdict string"), SITE_RULES).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        url = URLS[r.page_id % len(URLS)]
        rule, verdict = rule_of(url)
        assert (r.host, r.path) == parts(url) and (r.rule, r.verdict) == (rule, verdict or "allow"), url


def test_mined_rules_reach_support_confidence_and_lift(spark):
    labelled = [(f"http://s{i % 5}.example.net/{'bad' if i % 3 == 0 else 'good'}/{i}", "block" if i % 3 == 0 and i % 4 else "allow") for i in range(240)]
    frame = spark.createDataFrame([*labelled, ("http://x.y/", None)], "url string, verdict string")
    rules = mine_rules(frame, min_support=0.05, min_confidence=0.6, min_lift=1.2, min_rows=10).collect()
    items = [(set(r.t), v) for (r, (_, v)) in zip(spark.createDataFrame(labelled, "url string, v string").select(url_tokens(F.col("url")).alias("t")).collect(), labelled)]
    wanted = {}
    for tokens, _ in items:
        for k in range(1, len(tokens) + 1):
            for some in combinations(sorted(tokens), k):
                wanted.setdefault(some, None)
    for some in wanted:
        with_them = [v for t, v in items if set(some) <= t]
        wanted[some] = {v: (with_them.count(v) / len(with_them), with_them.count(v) / len(items)) for v in ("block", "allow")}
    share = {v: sum(w == v for _, w in items) / len(items) for v in ("block", "allow")}
    expected = {(s, v) for s, both in wanted.items() for v, (c, n) in both.items() if c >= 0.6 and n >= 0.05 and c / share[v] >= 1.2}
    assert {(tuple(sorted(r.tokens)), r.verdict) for r in rules} == expected and expected
    # Matching by the inverted index gives the best of all rules that fit.
    table = mine_rules(frame, 0.05, 0.6, 1.2, 10)
    urls = [u for u, _ in labelled[:20]] + ["http://s1.example.net/other/", ""]
    got = {r.url: r.mined for r in match_rules(spark.createDataFrame([(u,) for u in urls], "url string"), table).collect()}
    for u in urls:
        tokens = set(spark.createDataFrame([(u,)], "url string").select(url_tokens(F.col("url"))).first()[0])
        fits = [(r.confidence, r.support, " ".join(sorted(r.tokens)), r.verdict) for r in rules if set(r.tokens) <= tokens]
        assert got.get(u) == (max(fits)[3] if fits else None)


def test_tokens_are_bounded(spark):
    url = "http://" + "a." * 500 + "b/" + "c/" * 500 + "?" + "&".join(f"k{i}=1" for i in range(500))
    assert spark.createDataFrame([(url,)], "url string").select(F.size(url_tokens(F.col("url")))).first()[0] <= 10


def test_words_anywhere_in_a_url_are_tokens(spark):
    url = "http://m.Casino-win.example.com/a/b/c7/best-pills.html?q=Deal#z"
    got = set(spark.createDataFrame([(url,)], "url string").select(all_tokens(F.col("url"))).first()[0])
    assert got >= {"label=casino-win", "part=c0", "pair=q=Deal", "word=casino", "word=pills", "word=deal", "host=m.casino-win.example.com"}


def test_rules_reach_across_hosts_and_do_not_need_more_rows_in_a_larger_table(spark):
    """40 bad urls among 12,000, on hosts of four urls each: 0.3 %, below the least share."""
    bad = [f"http://{sub}{i}.casino-win.site{chr(97 + i)}.net/x/y/z/{i}" for i in range(10) for sub in ("m", "www", "blog", "go")]
    deep = [f"http://a.place{chr(97 + i % 26)}.net/x/y/z/cheap-pills-{i}?q=1" for i in range(40)]
    good = [f"http://{w}.{chr(97 + i % 26)}ther.net/x/y/z/{i}?q=1" for i in range(3980) for w in ("m0", "www0", "blog0")]
    frame = spark.createDataFrame([(u, "block") for u in bad + deep] + [(u, "allow") for u in good], "url string, verdict string")
    asked = ["http://new.casino-win.other.net/x/y/z/1", "http://a.else.net/p/q/r/cheap-pills-now", "http://www0.ather.net/x/y/z/77?q=1"]
    pages = spark.createDataFrame(list(enumerate(asked)), "page_id long, url string")
    assert {r.page_id: r.verdict for r in judge_urls(pages, frame, ()).collect()} == {0: "block", 1: "block", 2: "allow"}


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(none, spark.createDataFrame([], "url string, verdict string"), SITE_RULES).collect() == []
    assert host_and_path(F.lit("x")) is not None
