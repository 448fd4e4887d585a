"""URL verdicts: given site rules first, then association rules between URL tokens and labels, mined by FP-growth.

Only DataFrame functions and Spark's own FP-growth. FP-growth gets the ten places of a URL, so a URL lies in at most 2 ** 10
token sets, and the rules that reach a support s number at most 2 ** 10 / s, however many URLs there are. Every host
label, folder, query value and word is a token besides; of all tokens that are no rare ones, rules of one or two are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khodat.llm.common import stored

#: Least share of the labelled URLs that hold a rule's tokens and its verdict.
MIN_SUPPORT = 0.005
#: And the least number of them.
MIN_ROWS = 10
#: Least share of the URLs with a rule's tokens that have its verdict.
MIN_CONFIDENCE = 0.6
#: Least confidence against the share of the verdict among all labelled URLs.
MIN_LIFT = 1.2

#: Standard deviations by which a rule of one or two tokens must exceed the share of its verdict.
MIN_SIGMAS = 4

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
    ``#`` or the end. Null or without ``://``: both empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), "^[^?#]*", 0)
    empty = F.lit("")
    return F.coalesce(F.translate(host, UPPER, LOWER), empty), F.coalesce(path, empty)


def site_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest of ``rules`` (verdict, host, path) whose host is ``host`` or a domain above it and whose path begins
    ``path``, as a struct of rule and verdict; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, on, below in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(below)
        found = F.when(fits, F.struct(F.lit(on + below).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, top domain, site, host, label before the site, first and second folder, the ending of the last
    part, names in the query, whether there is a fragment. Digits of host and folders count as 0. Places that a URL
    lacks give no token; null gives none."""
    host, path = host_and_path(url)
    zeroed = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    labels = F.split(host, "\\.")
    parts = F.split(path, "/")
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    part = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))
    places = {
        "scheme": F.when(F.locate("://", url) > 0, F.substring_index(url, "://", 1)).otherwise(""),
        "top": F.element_at(labels, -1),
        "site": F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), F.lit(2)), "."),
        "host": zeroed(host),
        "sub": F.when(F.size(labels) > 2, zeroed(labels[0])).otherwise(""),
        "folder": zeroed(part(2)),
        "second": zeroed(part(3)),
        "ending": F.regexp_extract(path, "(\\.[A-Za-z0-9]+|/)$", 1),
        "names": F.array_join(F.array_sort(F.array_distinct(F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1)))), "&"),
        "fragment": F.when(F.locate("#", url) > 0, "yes").otherwise(""),
    }
    tokens = F.array(*[F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{k}="), c)) for k, c in places.items()])
    return F.filter(tokens, lambda t: t.isNotNull())


def all_tokens(url: Column) -> Column:
    """``url_tokens`` and, wherever they stand, each host label, folder, query pair, and each word in any of them (A-Z
    lower-cased). Digits count as 0; numbers alone are no words."""
    host, path = host_and_path(url)
    zeroed = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    kinds = {
        "label": F.split(zeroed(host), "\\."),
        "part": F.split(zeroed(path), "/"),
        "pair": F.split(zeroed(query), "&"),
        "word": F.filter(F.split(F.translate(F.concat_ws("/", host, path, query), UPPER, LOWER), "[^\\p{L}\\p{N}]+"), lambda w: w.rlike("\\p{L}")),
    }
    named = lambda kind, c: F.transform(F.filter(c, lambda t: t != ""), lambda t: F.concat(F.lit(f"{kind}="), t))
    more = [named(kind, c) for kind, c in kinds.items()]
    return F.array_distinct(F.concat(url_tokens(url), *[F.coalesce(m, F.array().cast("array<string>")) for m in more]))


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) from ``labelled`` (url, verdict); rows with a null verdict teach nothing.

    A rule stays if it reaches the least support (share and rows), confidence and lift. No labelled rows give no rules.
    """
    items = labelled.where(F.col("verdict").isNotNull()).select(
        F.concat(url_tokens(F.col("url")), F.array(F.concat(F.lit("verdict="), "verdict"))).alias("items")
    )
    support = min(1.0, max(min_support, min_rows / max(1, items.count())))
    rules = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items).associationRules
    verdict = F.col("consequent")[0]
    return rules.where(verdict.startswith("verdict=") & (F.col("lift") >= min_lift)).select(
        F.col("antecedent").alias("tokens"), F.substring_index(verdict, "verdict=", -1).alias("verdict"), "confidence", "support",
    )


def mine_short_rules(
    labelled: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, min_rows: int = MIN_ROWS, min_sigmas: float = MIN_SIGMAS,
) -> DataFrame:
    """Rules like those of ``mine_rules`` of one or two of ``all_tokens``. The least support is a number of rows, whatever the size
    of the table; a verdict must also exceed its share by ``min_sigmas`` deviations. A rule of two stays only if it is
    surer than each of its tokens alone."""
    items = stored(
        labelled.where(F.col("verdict").isNotNull()).select(F.monotonically_increasing_id().alias("row"), all_tokens(F.col("url")).alias("tokens"), "verdict"),
        "url-tokens",
    )
    total = items.count()
    shares = items.groupBy("verdict").agg((F.count("*") / F.lit(max(1, total))).alias("share"))
    per_token = items.select("row", "verdict", F.explode("tokens").alias("token"))
    frequent = per_token.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= min_rows).select("token")
    left = stored(
        per_token.join(frequent, "token").groupBy("row", "verdict").agg(F.array_sort(F.collect_list("token")).alias("tokens")), "url-frequent-tokens"
    )

    def counted(sets: DataFrame) -> DataFrame:
        """Rows (tokens, verdict, held, confidence) of ``sets`` (tokens, verdict) with the least number of rows."""
        held = sets.groupBy("tokens", "verdict").agg(F.count("*").alias("held"))
        per_set = held.groupBy("tokens").agg(F.sum("held").alias("n"), F.collect_list(F.struct("verdict", "held")).alias("of"))
        return per_set.select("tokens", "n", F.inline("of")).where(F.col("held") >= min_rows).withColumn("confidence", F.col("held") / F.col("n"))

    singles = stored(counted(left.select(F.explode("tokens").alias("token"), "verdict").select(F.array("token").alias("tokens"), "verdict")), "url-singles")
    both = F.flatten(F.transform("tokens", lambda a, i: F.transform(F.slice("tokens", i + 2, F.size("tokens")), lambda b: F.array(a, b))))
    alone = lambda i: singles.select(F.col("tokens")[0].alias(f"t{i}"), "verdict", F.col("confidence").alias(f"c{i}"))
    pairs = counted(left.select(F.explode(both).alias("tokens"), "verdict")).where(F.col("confidence") >= min_confidence)
    pairs = (
        pairs.withColumns({"t0": F.col("tokens")[0], "t1": F.col("tokens")[1]})
        .join(alone(0), ["t0", "verdict"]).join(alone(1), ["t1", "verdict"]).where(F.col("confidence") > F.greatest("c0", "c1"))
        .select("tokens", "n", "verdict", "held", "confidence")
    )
    share, n = F.col("share"), F.col("n")
    return (
        singles.select("tokens", "n", "verdict", "held", "confidence").unionByName(pairs).join(F.broadcast(shares), "verdict")
        .where((F.col("confidence") >= min_confidence) & (F.col("confidence") >= min_lift * share))
        .where(F.col("confidence") - share >= min_sigmas * F.sqrt(share * (1 - share) / n))
        .select("tokens", "verdict", "confidence", (F.col("held") / F.lit(max(1, total))).alias("support"))
    )


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct url that fits a rule, the verdict of the best: most confidence, then support, then tokens in order.

    An inverted index leads to a rule from that token of it which the fewest rules hold; the others are then looked up.
    """
    ranked = rules.select("verdict", "confidence", "support", F.array_join(F.array_sort("tokens"), " ").alias("name"), "tokens").distinct()
    each = ranked.withColumn("token", F.explode("tokens"))
    held = each.groupBy("token").agg(F.count("*").alias("held"))
    index = each.join(held, "token").groupBy(*ranked.columns).agg(F.min_by("token", F.struct("held", "token")).alias("token"))
    reached = (
        urls.select("url").distinct().withColumn("own", all_tokens(F.col("url"))).withColumn("token", F.explode("own"))
        .join(index, "token").where(F.size(F.array_except("tokens", "own")) == 0)
    )
    best = F.max_by(F.struct("verdict", "name"), F.struct("confidence", "support", "name", "verdict"))
    return reached.groupBy("url").agg(best.alias("best")).select("url", F.col("best.verdict").alias("mined"), F.col("best.name").alias("mined_rule"))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Every row of ``pages`` (page_id, url) with host, path, the site rule that fits, the verdict, and the mined rule if
    that decided. A URL that fits neither kind of rule is allowed. Null and empty URLs fit none. Repeated rows are
    judged alike; an empty table gives no rows. Other columns are not read."""
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", "url").withColumns({"host": host, "path": path}).withColumn("site", site_rule(F.col("host"), F.col("path"), rules))
    labelled = stored(labelled.select("url", "verdict"), "url-labels")
    rules_mined = stored(mine_rules(labelled).unionByName(mine_short_rules(labelled)), "url-rules")
    mined = match_rules(judged.where("site is null and url is not null"), rules_mined)
    return judged.join(mined, "url", "left").select(
        "page_id", "host", "path", F.col("site.rule").alias("rule"),
        F.coalesce("site.verdict", "mined", F.lit("allow")).alias("verdict"),
        F.when(F.col("site").isNull(), F.col("mined_rule")).alias("mined_rule"),
    )
