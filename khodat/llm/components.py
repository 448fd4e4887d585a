"""Connected components of a graph that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khodat.llm.common import stored


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """For each id in ``links`` (two long columns), the smallest id that links reach from it: columns id, component.

    In each round every id moves to the neighbour, or itself, that a hash of id and round ranks lowest; links then join
    the places moved to, and links within one place vanish. A round at least halves a star or a clique to one id and shortens a chain by a
    constant share, so rounds grow with the logarithm of the ids. An id with very many links is reduced to a minimum in
    each task before anything is sent. Null ids are left out; repeated links and links to oneself change nothing.
    """
    links = stored(
        links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    places = stored(links.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("place", F.col("id")), "places")
    edges, turn = links.where("a <> b"), 0
    while not edges.isEmpty():
        rank = lambda c: F.xxhash64(F.lit(turn), c)  # noqa: E731, B023
        lowest = F.min(F.struct(rank("to").alias("rank"), F.col("to").alias("to")))
        moves = stored(
            edges.select("a", F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("to")))
            .groupBy("a").agg(lowest.alias("best"))
            .select(F.col("a").alias("old"), F.when(F.col("best.rank") < rank("a"), F.col("best.to")).otherwise(F.col("a")).alias("new")),
            "moves",
        )
        places = stored(
            places.join(moves, F.col("place") == F.col("old"), "left").select("id", F.coalesce("new", "place").alias("place")), "places",
        )
        edges = stored(
            edges.join(moves, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b")
            .join(moves, F.col("b") == F.col("old")).select("a", F.col("new").alias("b")).where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
        turn += 1
    names = places.groupBy("place").agg(F.min("id").alias("component"))
    return places.join(names, "place").select("id", "component")
