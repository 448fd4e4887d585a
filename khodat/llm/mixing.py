"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from khodat.llm.common import column, fresh, numbered, stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
SEED = 17
#: Documents in one block of a source, on average; only one block of each source is looked at document by document.
BLOCK_ROWS = 1 << 12


@F.pandas_udf(T.LongType())
def count_words(texts: pd.Series) -> pd.Series:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in each text; null has none."""
    return pd.Series([0 if t is None else len(t.encode().split()) for t in texts], dtype="int64")


def water_fill(sources: DataFrame, most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight) with its target.

    All sizes together are shared by weight. A target above ``most_epochs`` times its source's size is clamped there
    and its excess shared anew by weight among the others, until none is above. The loop runs over sources on Spark;
    the driver holds three sums. There are at most as many rounds as sources.
    """
    cap = F.col("source_size") * F.lit(float(most_epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    clamped = -1
    while True:
        full = F.col("weight") * F.lit(level) > cap if clamped >= 0 else F.lit(False)
        held, weight, n = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(full, 1)),
        ).first()
        if n == clamped or not weight:
            return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))
        clamped, level = n, (total - held) / weight


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most_epochs: float = MOST_EPOCHS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source) with how often the mix takes it.

    Columns: row (its number in the stored table), doc_id, size, source_size, target, repeats. Size is the number of
    words, 0 for null. Sources in code point order, null last, weigh ``weights`` in turn. Each document is taken
    ``floor(target / source_size)`` times, and a seeded choice once more: documents of a source stand in the order of a
    seeded hash, and a document is chosen if it still fits into what is left of the target (or stays out, if it fits into
    what is too much, where that is less). So the words taken miss the target by less than the shortest document passed
    over. Blocks before the one where the target is reached are
    taken whole, those behind not at all. A source without words has target 0. Repeated rows are rows of their own;
    reruns give the same result. An empty table gives no rows.
    """
    sizes = stored(
        numbered(docs.select("doc_id", "source", count_words("text").alias("size"), F.xxhash64("text").alias("same")), "row")
        .withColumn("turn", F.xxhash64(F.lit(seed), "doc_id", "same")),
        "sizes",
    )
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.pmod(place, F.lit(len(weights))) + 1)
    sources = stored(
        water_fill(
            stored(
                sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")).withColumn("weight", weight),
                "sources",
            ),
            most_epochs,
        )
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("whole", F.floor("rate")).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("blocks", F.col("rows") / BLOCK_ROWS + 1).withColumn("blocks", F.col("blocks").cast("long")),
        "targets",
    )
    # The top bits of the seeded hash choose the block, so blocks follow one another in the order of the hash.
    share = F.shiftrightunsigned("turn", 33) / float(1 << 31)
    rows = (
        sizes.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("block", F.floor(share * F.col("blocks"))).drop("of", "weight", "rate", "rows", "blocks")
    )
    until = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = (
        rows.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("part").alias("part"))
        .withColumn("after", F.sum("words").over(until)).withColumn("left", F.col("part") - (F.col("after") - F.col("words")))
        .select(F.col("source").alias("of"), F.col("block").alias("nr"), "words", "left")
    )
    rows = rows.join(blocks, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("nr"))).drop("of", "nr", "block")
    out = ["row", "doc_id", "size", "source_size", "target"]
    split = (F.col("left") > 0) & (F.col("left") < F.col("words"))
    plain = rows.where(~split).select(*out, (F.col("whole") + (F.col("left") > 0).cast("long")).cast("int").alias("repeats"))

    def choose(block: pa.Table) -> pa.Table:
        block = block.sort_by([("turn", "ascending"), ("row", "ascending")])
        left, words, repeats = block["left"][0].as_py(), block["words"][0].as_py(), block["whole"].to_numpy().astype(np.int32)
        # The smaller part is chosen document by document: what comes in, or what stays out.
        step, left = (1, left) if 2 * left <= words else (-1, words - left)
        if step < 0:
            repeats = repeats + 1
        for i, size in enumerate(block["size"].to_pylist()):
            if size <= left:
                repeats[i] += step
                left -= size
        return block.select(out).append_column("repeats", pa.array(repeats, pa.int32()))

    chosen = rows.where(split).groupBy("source").applyInArrow(
        choose, "row long, doc_id long, size long, source_size long, target double, repeats int",
    )
    return plain.unionByName(chosen)


def mix_digest(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document, in words."""
    return mix_plan(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).cast("long").alias("taken"), "repeats",
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most_epochs: float = MOST_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs``, each row as often as the mix takes it, with all its columns. ``docs`` must be a stored table."""
    row = fresh(docs, "row")
    plan = mix_plan(docs, weights, most_epochs, seed).where("repeats > 0").select(F.col("row").alias(row), F.col("repeats").alias(f"{row}_repeats"))
    return (
        numbered(docs, row).join(plan, row)
        .select(*[column(c) for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(f"{row}_repeats"))).alias(f"{row}_copy"))
        .select(*[column(c) for c in docs.columns])
    )
