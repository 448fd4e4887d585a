"""Near duplicates among vectors by sorted projection passes.

In each pass a vector's signs on random hyperplanes, concatenated, are its place in a lexicographic order; similar vectors
come near each other in some pass. Each vector is compared with a bounded window of those behind it; where more vectors
than a window share as many first signs as should tell a window apart, all pairs of these are compared in blocks. The pairs
that hold are united across passes. Within the components found so, all pairs are then compared in blocks, so that links are
counted whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from khodat.llm.common import numbered, stored
from khodat.llm.components import components

LEAST_COSINE = 0.98
#: Vectors that each vector is compared with in a pass.
WINDOW = 64
#: Vectors in a block of a pass, and of the counting; more than a window.
BLOCK = 2048
#: How often a pair at the threshold may be missed by all passes.
MISSED = 1e-5
SEED = 11


def prefix_bits(n: int, window: int = WINDOW) -> int:
    """First signs that tell a window apart among ``n`` vectors that are spread evenly."""
    return math.ceil(math.log2(max(n, window) / window))


def passes_for(n: int, least: float = LEAST_COSINE, window: int = WINDOW, missed: float = MISSED) -> int:
    """Passes that find a pair at the threshold among ``n`` vectors: it must agree in ``prefix_bits`` signs, however the others
    are spread."""
    agree = 1 - math.acos(least) / math.pi
    met = agree ** prefix_bits(n, window)
    return 1 if met >= 1 else math.ceil(math.log(missed) / math.log(1 - met))


def unit_rows(values: list[bytes], kind: str) -> np.ndarray:
    """Vectors of equal length as rows of length 1 in double precision."""
    rows = np.frombuffer(b"".join(values), kind).reshape(len(values), -1).astype(np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of ``n`` places, joined by the links (a, b)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        following = root.copy()
        np.minimum.at(following, root[a], least)
        np.minimum.at(following, root[b], least)
        following = following[following]
        if np.array_equal(following, root):
            return root
        root = following


def usable(vectors: DataFrame, kind: str) -> DataFrame:
    """Every row (row, vec_id, label) with its vector as bytes; null where it can't be compared: without label, null,
    empty, zero, or with a component that is null or not finite."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for label, vector in zip(batch.column("label").to_pylist(), batch.column("embedding")):
                own = None
                if label is not None and vector.is_valid and len(vector.values) and not vector.values.null_count:
                    values = vector.values.to_numpy(zero_copy_only=False)
                    own = values.astype(kind).tobytes() if np.isfinite(values).all() and values.any() else None
                raw.append(own)
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row"), "vec_id": batch.column("vec_id"), "label": batch.column("label"), "raw": pa.array(raw, pa.binary()),
            })

    return (
        numbered(vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding"), "row")
        .mapInArrow(read, "row long, vec_id long, label long, raw binary")
    )


def crowded_links(sorted_rows: DataFrame, kind: str, bits: int, least: float, window: int, block: int) -> DataFrame:
    """Links (a, b) among all vectors of a pass that share the first ``bits`` signs, where these are more than a window
    holds: block against block, from each member of a component to its first one."""
    # The sign bit of a key only shifts the range.
    named = sorted_rows.withColumn("bucket", F.xxhash64("pass", "label", "size", F.shiftright("key", 64 - bits) if bits else F.lit(0)))
    sizes = stored(named.groupBy("bucket").agg(F.count("*").alias("rows")).where(F.col("rows") > window + 1), "crowded")
    tasks = max(1, (sizes.agg(F.sum("rows")).first()[0] or 0) // (8 * block))
    blocks = F.ceil(F.col("rows") / block).cast("int")
    rows = (
        named.join(sizes, "bucket").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")})
        .withColumn("task", F.when(F.col("blocks") == 1, F.pmod("bucket", F.lit(tasks))).otherwise(F.xxhash64("bucket", "first", "second")))
        .select("task", "bucket", "size", "first", "second", "own", "class", "raw")
    )

    def compare(group: pa.Table) -> pa.Table:
        columns = {c: group[c].to_numpy() for c in ("bucket", "size", "first", "second", "own", "class")}
        raw, found = group["raw"].to_pylist(), [np.zeros((0, 2), np.int64)]
        order = np.lexsort([columns[c] for c in ("second", "first", "size", "bucket")])
        change = np.flatnonzero(np.any([np.diff(columns[c][order]) != 0 for c in ("bucket", "size", "first", "second")], axis=0)) + 1
        for part in np.split(order, change):
            names = columns["class"][part]
            unit = unit_rows([raw[i] for i in part], kind)
            left, right = (np.flatnonzero(columns["own"][part] == columns[c][part]) for c in ("first", "second"))
            a, b = np.nonzero(unit[left] @ unit[right].T >= least)
            root = local_roots(len(part), left[a], right[b])
            moved = np.flatnonzero(root != np.arange(len(part)))
            found.append(np.stack([names[root[moved]], names[moved]], 1))
        links = np.concatenate(found)
        return pa.table({"a": pa.array(links.min(1) if len(links) else links[:, 0]), "b": pa.array(links.max(1) if len(links) else links[:, 0])})

    return rows.groupBy("task").applyInArrow(compare, "a long, b long")


def window_links(classes: DataFrame, kind: str, passes: int, bits: int, least: float, window: int, block: int) -> DataFrame:
    """Links (a, b) that the passes find among ``classes`` (class, label, raw): in each block, from each member of a
    component to its first one."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for batch in batches:
            raw = np.array(batch.column("raw").to_pylist(), object)
            for size in np.unique([len(v) for v in raw]).tolist() if len(raw) else []:
                own = np.flatnonzero([len(v) == size for v in raw])
                rows = unit_rows(raw[own].tolist(), kind)
                if size not in planes:
                    planes[size] = np.random.default_rng([SEED, size]).normal(size=(rows.shape[1], 64 * passes))
                signs = (rows @ planes[size] > 0).reshape(len(own), passes, 64)
                # The order of unsigned keys is kept by signed ones that begin half the range lower.
                keys = ((signs * weights).sum(2, dtype=np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
                for p in range(passes):
                    yield pa.RecordBatch.from_pydict({
                        "pass": pa.array(np.full(len(own), p, np.int32)), "label": batch.column("label").take(pa.array(own)),
                        "size": pa.array(np.full(len(own), size, np.int32)), "key": pa.array(keys[:, p]),
                        "class": batch.column("class").take(pa.array(own)), "raw": batch.column("raw").take(pa.array(own)),
                    })

    order = ["pass", "label", "size", "key", "class"]
    projected = classes.select("class", "label", "raw").mapInArrow(project, "pass int, label long, size int, key long, class long, raw binary")
    # Place in the order of a whole pass: the partition, then the place in it; the partitions' sizes turn it into a rank.
    sorted_rows = stored(projected.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "passes")
    part = F.shiftright("place", 33)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sorted_rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1)
    # The rows at the end of a block also open the next one.
    block_of = F.when(F.col("rank") % block >= block - window, F.array(F.floor(F.col("rank") / block), F.floor(F.col("rank") / block) + 1)).otherwise(
        F.array(F.floor(F.col("rank") / block))
    )
    blocks = (
        sorted_rows.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", rank)
        .select("pass", "label", "size", "class", "raw", "rank", F.explode(block_of).alias("block"))
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        names = group["class"].to_numpy()
        runs = np.flatnonzero(np.r_[True, np.any([np.diff(group[c].to_numpy()) != 0 for c in ("pass", "label", "size")], axis=0), True])
        raw, found = group["raw"].to_pylist(), [np.zeros((0, 2), np.int64)]
        for start, end in zip(runs[:-1].tolist(), runs[1:].tolist()):
            rows = unit_rows(raw[start:end], kind)
            hits = [np.zeros((0, 2), np.int64)]
            for step in range(1, min(window, end - start - 1) + 1):
                at = np.flatnonzero(np.einsum("ij,ij->i", rows[:-step], rows[step:]) >= least)
                hits.append(np.stack([at, at + step], 1))
            pairs = np.concatenate(hits)
            if len(pairs):
                root = local_roots(end - start, pairs[:, 0], pairs[:, 1])
                moved = np.flatnonzero(root != np.arange(end - start))
                found.append(np.stack([names[start + root[moved]], names[start + moved]], 1))
        links = np.concatenate(found)
        return pa.table({"a": pa.array(links.min(1) if len(links) else links[:, 0]), "b": pa.array(links.max(1) if len(links) else links[:, 0])})

    near = blocks.groupBy("block").applyInArrow(compare, "a long, b long")
    return near.unionByName(crowded_links(sorted_rows, kind, bits, least, window, block))


def counted_links(members: DataFrame, kind: str, least: float, block: int) -> DataFrame:
    """For each of ``members`` (class, group, copies, raw) that is linked to others of its group, how many vectors these are:
    columns class, others. Large groups are compared block against block."""
    blocks = members.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    task = F.when(F.col("blocks") == 1, F.pmod(F.col("group"), F.lit(256))).otherwise(F.xxhash64("group", "first", "second"))
    rows = (
        members.join(blocks, "group").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")}).withColumn("task", task)
        .select("task", "group", "first", "second", "own", "class", "copies", "raw")
    )

    def count(batch: pa.Table) -> pa.Table:
        columns = {c: batch[c].to_numpy() for c in ("group", "first", "second", "own", "class", "copies")}
        raw = batch["raw"].to_pylist()
        order = np.lexsort((columns["second"], columns["first"], columns["group"]))
        change = np.flatnonzero(np.any([np.diff(columns[c][order]) != 0 for c in ("group", "first", "second")], axis=0)) + 1
        others = np.zeros(len(order), np.int64)
        for part in np.split(order, change):
            left, right = part[columns["own"][part] == columns["first"][part]], part[columns["own"][part] == columns["second"][part]]
            if not len(left) or not len(right):
                continue
            a, b = unit_rows([raw[i] for i in left], kind), unit_rows([raw[i] for i in right], kind)
            hold = a @ b.T >= least
            if columns["first"][part[0]] == columns["second"][part[0]]:
                np.fill_diagonal(hold, False)
                others[left] += hold @ columns["copies"][right]
            else:
                others[left] += hold @ columns["copies"][right]
                others[right] += columns["copies"][left] @ hold
        return pa.table({"class": pa.array(columns["class"]), "others": pa.array(others)})

    return rows.groupBy("task").applyInArrow(count, "class long, others long").groupBy("class").agg(F.sum("others").alias("others"))


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Every row of ``vectors`` (vec_id, embedding, label) with its links to others of the same label.

    Two vectors of equal length and equal label are linked if their cosine, in double precision, is at least ``least``.
    Vectors without a label, and those that are null, empty, zero or hold null or non-finite components, have no link.
    Equal vectors are one class that the passes see once; each of its members counts. Columns: row (number in the stored
    table), vec_id, n_links, component_id (the smallest vec_id that links reach, itself included), kept (vec_id is that).
    Rows that repeat are vectors of their own. An empty table gives no rows.
    """
    kind = "<f8" if isinstance(vectors.schema["embedding"].dataType.elementType, T.DoubleType) else "<f4"
    rows = stored(usable(vectors, kind), "vectors")
    classes = stored(
        rows.where("raw is not null").groupBy("label", "raw")
        .agg(F.min("row").alias("class"), F.count("*").alias("copies"), F.min("vec_id").alias("least_id")),
        "vector-classes",
    )
    n = classes.count()
    linked = stored(
        components(window_links(classes, kind, passes_for(n, least, window), prefix_bits(n, window), least, window, block)), "components",
    )
    members = classes.join(linked, F.col("class") == F.col("id")).select("class", F.col("component").alias("group"), "copies", "raw", "least_id")
    counts = counted_links(members, kind, least, block)
    names = members.groupBy("group").agg(F.min("least_id").alias("component_id"))
    found = members.join(names, "group").join(counts, "class", "left").select("class", "component_id", "others")
    per_class = stored(
        classes.join(found, "class", "left").select(
            "label", "raw", F.coalesce("component_id", "least_id").alias("component_id"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "links-of-classes",
    )
    alone = F.col("n_links").isNull()
    return rows.join(per_class, ["label", "raw"], "left").select(
        "row", "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
