"""Shards of nearly equal bytes in which equal texts stay together (Karmarkar-Karp differencing).

Differencing runs over at most 2 * ``units`` indivisible units, whatever the number of documents: each group of equal
texts that holds a ``1 / units`` share of all bytes or more is a unit of its own (there can be no more than ``units`` of
those), and the smaller groups are dealt by hash into ``units`` bundles. So one bounded task decides, and documents are
not shuffled for it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from khodat.llm.common import numbered, stored

#: Bundles for small groups; differencing sees at most twice as many units.
UNITS = 8192
#: Rows in one block of the numbering within a shard, on average.
BLOCK_ROWS = 1 << 16


def difference(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size by multiway differencing.

    Each size starts as a partial partition with everything in one subset. The two partial partitions with the largest
    spread are combined again and again, the largest subset of one with the smallest of the other, until one is left.
    Ties go by age, so equal input gives equal output. No sizes give no shards.
    """
    if not sizes:
        return []
    # A node is (left, right, order): subset p of it joins left subset order[p] and right subset shards-1-order[p].
    nodes: list[tuple[int, int, list[int]]] = []
    sums: list[list[int]] = [[s] + [0] * (shards - 1) for s in sizes]
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joined = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        order = sorted(range(shards), key=lambda p: -joined[p])
        nodes.append((a, b, order))
        sums.append([joined[p] for p in order])
        sums[a] = sums[b] = []
        heapq.heappush(heap, (sums[-1][-1] - sums[-1][0], len(sums) - 1))
    # Walk down from the whole partition, carrying which shard each subset of a node became.
    became: dict[int, list[int]] = {heap[0][1]: list(range(shards))}
    for i in range(len(sums) - 1, len(sizes) - 1, -1):
        a, b, order = nodes[i - len(sizes)]
        shard_of, left, right = became.pop(i), [0] * shards, [0] * shards
        for p, q in enumerate(order):
            left[q] = right[shards - 1 - q] = shard_of[p]
        became[a], became[b] = left, right
    return [became[i][0] for i in range(len(sizes))]


def shard_documents(docs: DataFrame, shards: int = 8, units: int = UNITS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard and its place in it.

    Size is the UTF-8 bytes of the text plus 1; null counts as the empty text, also for equality. Equal texts share a
    shard. A group that exceeds an equal share cannot be divided: it gets a shard, and the others balance beside it.
    Slots run from 0 in each shard without gaps. Repeated rows are rows of their own. An empty table gives no rows.
    Other columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(
        numbered(
            docs.select(
                "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                F.unhex(F.sha2(text, 256)).alias("same"),
            ),
            "row",
        ),
        "sizes",
    )
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    large = F.col("bytes") * units >= F.lit(total or 0)
    groups = rows.groupBy("same").agg(F.sum("size").alias("bytes"))
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("same"), F.lit(units)))

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = pd.concat([pd.DataFrame({"unit": pd.Series(dtype=str), "bytes": pd.Series(dtype="int64")}), *frames])
        seen = seen.sort_values(["bytes", "unit"], ascending=[False, True])
        yield pd.DataFrame({"unit": seen["unit"], "shard": pd.Series(difference(seen["bytes"].tolist(), shards), seen.index, "int32")})

    decided = stored(
        groups.withColumn("unit", F.when(large, F.hex("same")).otherwise(bundle))
        .groupBy("unit").agg(F.sum("bytes").alias("bytes"))
        .repartition(1).mapInPandas(decide, "unit string, shard int"),
        "shards-of-units",
    )
    # Both broadcast sides hold at most 2 * units short rows.
    alone = F.broadcast(decided.where(~F.col("unit").startswith("bundle ")).select(F.unhex("unit").alias("same"), F.col("unit").alias("own")))
    placed = (
        rows.join(alone, "same", "left").withColumn("unit", F.coalesce("own", bundle))
        .join(F.broadcast(decided), "unit")
        .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n // BLOCK_ROWS + 1)))
        .select("doc_id", "size", "text_crc32", "shard", "block", "row")
    )
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "block").agg(F.count("*").alias("rows"))
        .select("shard", "block", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("shard", "block").orderBy("row")
    return (
        placed.withColumn("place", F.row_number().over(within) - 1).join(starts, ["shard", "block"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
