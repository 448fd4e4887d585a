"""Spelling variants: words one edit apart, and the frequent form that each rare one stands for.

Asymmetric q-chunks. Of two words the longer gives two disjoint chunks, its halves; the other gives its positional grams of those
lengths. One edit spares one of the chunks: the first keeps its place, the second is shifted by the difference in
length, at most one, so of all grams only those two places can hold them. Words are joined where chunk and gram agree,
and each pair is verified.

A chunk that many words share, such as a common ending, would bring all of them together. What is left of those words beside the
chunk is then taken for a word, and halved in turn, until few enough agree or one letter is left; more than the
alphabet has cannot differ in that.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khodat.llm.common import stored

#: Code points of a word: Latin letters without and with accents (fixed values).
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: One run in so many loses a code point.
DAMAGE = 97
#: Words of one side that may share a chunk before it is halved on. It changes no result.
TOGETHER = 64


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def spelled(docs: DataFrame) -> DataFrame:
    """Every run of every text, as ``word``. Where DAMAGE divides the checksum of ``<doc_id>:<run>``, the run lacks the code point at that
    checksum modulo its length. Null texts have no runs; a null doc_id damages none."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"), 1)).alias("run")).select("doc_id", lower_ascii(F.col("run")).alias("run"))
    checked = runs.withColumn("sum", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary")))
    at = F.pmod("sum", F.char_length("run")).cast("int")
    damaged = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return checked.select(F.when(F.col("sum") % DAMAGE == 0, damaged).otherwise(F.col("run")).alias("word"))


def counted_words(docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """The distinct words of at least so many code points that occur at least so often, with their number n."""
    return spelled(docs).where(F.char_length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def _halved(items: DataFrame) -> DataFrame:
    """Each item twice: keyed by its piece at the place of the first half of the chunk side's rest, and of the second; what lies beside
    the piece is the new rest. ``size`` is the length of the chunk side's rest, ``short`` by how much the own is shorter."""
    half = F.floor(F.col("size") / 2).cast("int")
    first = F.struct(
        F.xxhash64("key", F.lit(1), "size", F.substr("rest", F.lit(1), half)).alias("key"), F.substr("rest", half + 1).alias("rest"),
        (F.col("size") - half).alias("size"),
    )
    second = F.struct(
        F.xxhash64("key", F.lit(2), "size", F.substr("rest", half + 1 - F.col("short"))).alias("key"),
        F.substr("rest", F.lit(1), half - F.col("short")).alias("rest"), half.alias("size"),
    )
    return items.select("word", "n", "chunk", "short", F.explode(F.array(first, second)).alias("part")).select(
        "part.key", "part.rest", "part.size", "word", "n", "chunk", "short",
    )


def near_words(words: DataFrame, together: int = TOGETHER) -> DataFrame:
    """All pairs of ``words`` (word, n; a stored table) that one inserted, deleted or replaced code point tells apart, each
    once: word and n of the longer, or smaller of equal length, other and other_n of the other."""
    length = F.char_length("word")
    side = lambda chunk, short: F.struct(F.lit(chunk).alias("chunk"), F.lit(short).alias("short"))
    items = words.select("word", "n", F.explode(F.array(side(True, 0), side(False, 0), side(False, 1))).alias("side")).select(
        F.lit(0).cast("long").alias("key"), F.col("word").alias("rest"), (length + F.col("side.short")).alias("size"), "word", "n",
        "side.chunk", "side.short",
    )
    found = None
    while True:
        items = stored(_halved(items), "items")
        chunks = F.count(F.when(F.col("chunk"), 1))
        # A word alone with itself is no key worth joining.
        counts = items.groupBy("key").agg(
            chunks.alias("chunks"), (F.count("*") - chunks).alias("grams"), F.min("size").alias("least"), (F.min("word") != F.max("word")).alias("several"),
        ).where("several and chunks > 0 and grams > 0")
        crowded = (F.col("least") > 1) & (F.greatest("chunks", "grams") > together)
        keyed = stored(items.join(counts.select("key", crowded.alias("crowded")), "key"), "keyed")
        few = keyed.where("not crowded")
        left = few.where("chunk").select("key", "word", "n")
        right = few.where("not chunk").select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
        order = (F.char_length("word") > F.char_length("other")) | (F.col("word") < F.col("other"))
        pairs = left.join(right, "key").where(order & (F.levenshtein("word", "other", 1) == 1)).drop("key")
        found = pairs if found is None else found.unionByName(pairs)
        items = keyed.where("crowded").drop("crowded")
        if items.isEmpty():
            return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """For each word of ``forms`` (word, form; each word once, no circles) the last word that its forms lead to: word, root. Each round
    doubles the steps taken."""
    steps = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        on = stored(steps.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        steps = on.drop("moved")
        if on.where("moved").isEmpty():
            return steps


def spelling_variants(docs: DataFrame, together: int = TOGETHER) -> DataFrame:
    """The words of ``docs`` (doc_id, text) with the form that each one is a variant of.

    Runs of letters in whole texts, A-Z lower-cased and some of them damaged (``spelled``), are words if they have at least five
    code points and occur three times or more. A word's form is the most frequent of its near words (ties: the first in
    code-point order), if that occurs at least twice as often. Columns: word, form or null, root (where forms lead in
    the end, the word itself if it has none), n, n_near, form_n. Null and empty texts have no words, null doc_ids damage none,
    rows that repeat count each, an empty table gives no rows. Counts are summed in each task before words are exchanged.
    """
    words = stored(counted_words(docs), "words")
    pairs = stored(near_words(words, together), "near")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("other"))).alias("best")
    near = both.groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), best).select(
        "word", "n_near", F.when(-F.col("best.minus") >= 2 * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.minus")).alias("form_n"))).alias("of"),
    )
    formed = stored(near.select("word", "n_near", "of.form", "of.form_n"), "forms")
    rooted = roots(formed.where("form is not null"))
    return words.join(formed, "word", "left").join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n",
    )
