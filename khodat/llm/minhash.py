"""Near duplicates by HyperMinHash: compressed minima propose pairs, full shingle sets decide.

A document's shingle hashes fall into 128 buckets. Of the smallest in each, a 16-bit register keeps the number of leading zeros and the
ten bits behind them. Bands of four registers propose; an estimate of the similarity, corrected for registers that agree
by chance, sorts out; the full sets confirm. Documents with equal sets are one class, and only classes are compared.

Within a bucket of equal bands not all pairs are formed. First each class is compared with the classes that lead most of
its buckets. What these links join needs no more comparing. Classes that share a bucket and are still apart then visit
each other's groups. In a bucket of few classes the member that looks most alike comes first, and if that is no link, all of
them. In a crowded one, classes are left out that have so many shingles for themselves that no other can reach the threshold;
the others are compared in blocks, estimate before full sets, and only links that join groups come out of a block. So
the groups are those that all pairs would give, and rows grow with classes, not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from khodat.llm.common import column, fresh, mixed, numbered, pack, stored, text_chunks, unpack, words_of
from khodat.llm.components import components

WORDS = 4
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
BUCKET_BITS = 7
MANTISSA_BITS = 10
#: Registers in a band, and bands: a pair at the threshold shares no band with probability 0.59 ** 24 < 4e-6.
BAND_ROWS = 4
BANDS = 24
#: An estimate so many standard deviations below the threshold rules a pair out (odds of a wrong one below 1e-6).
DEVIATIONS = 5.0
#: Leaders of its buckets that each class is compared with at first; what that leaves open is settled afterwards.
LEADERS = 3
#: Classes that may share a bucket before it counts as crowded.
CROWD = 64
#: Classes of one bucket in a block whose registers are compared.
BLOCK = 1024
#: Members of a group, and visitors, in a block whose full sets are compared.
MEETING = 256

#: Shingles of crowded classes that one task counts, and classes whose shingles are packed together. They change no result.
RANGE_SHINGLES = 1 << 22
SENT_CLASSES = 500

REST_BITS = 64 - BUCKET_BITS
POLYNOMIAL = np.uint64(0x100000001B3)
#: For each bucket the order in which it borrows from others.
LENDERS = np.random.default_rng(7).permuted(np.tile(np.arange(1 << BUCKET_BITS, dtype=np.uint8), (1 << BUCKET_BITS, 1)), axis=1)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending. Fewer words than a shingle has are one shingle; none are no shingle."""
    starts, ids, dictionary = words_of(texts)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in dictionary.to_pylist()], np.uint64)[ids]
    n = len(hashes) - words + 1
    rolled = hashes[: max(n, 0)].copy()
    for j in range(1, words):
        rolled *= POLYNOMIAL
        rolled += hashes[j : j + max(n, 0)]
    rolled = mixed(rolled)
    sets = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            sets.append(np.array([xxhash.xxh64_intdigest(hashes[a:b].tobytes(), seed=b - a)], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """For each set and bucket the register of its smallest hash: 1 + leading zeros, then the mantissa; 0 if the bucket is empty."""
    buckets = 1 << BUCKET_BITS
    bounds = np.arange(buckets, dtype=np.uint64) << np.uint64(REST_BITS)
    smallest, found = np.zeros((len(sets), buckets), np.uint64), np.zeros((len(sets), buckets), bool)
    for i, s in enumerate(sets):
        if len(s):
            at = np.searchsorted(s, bounds)
            own = s[np.minimum(at, len(s) - 1)]
            found[i] = (at < len(s)) & (own >> np.uint64(REST_BITS) == np.arange(buckets, dtype=np.uint64))
            smallest[i] = own
    rest = smallest & np.uint64((1 << REST_BITS) - 1)
    high, low = rest >> np.uint64(REST_BITS - 32), rest & np.uint64((1 << (REST_BITS - 32)) - 1)
    length = np.where(high > 0, np.frexp(high.astype(np.float64))[1] + REST_BITS - 32, np.frexp(low.astype(np.float64))[1])
    zeros = (REST_BITS - length).astype(np.uint64)
    behind = (rest << (zeros + np.uint64(1))) & np.uint64((1 << REST_BITS) - 1)
    mantissa = behind >> np.uint64(REST_BITS - MANTISSA_BITS)
    return np.where(found, ((zeros + np.uint64(1)) << np.uint64(MANTISSA_BITS)) | mantissa, 0).astype("<u2")


def band_keys(values: np.ndarray) -> np.ndarray:
    """Keys of the bands of each row of registers (rows without any register are not allowed). An empty bucket borrows the
    register of the first bucket that is not empty in a fixed random order of its own, so that small sets meet too."""
    n, buckets = values.shape
    filled = values.astype(np.uint64)
    rows, empty = np.nonzero(values == 0)
    for at in range(0, len(rows), 1 << 15):
        some, of = rows[at : at + (1 << 15)], empty[at : at + (1 << 15)]
        lenders = LENDERS[of]
        first = (values[some[:, None], lenders] > 0).argmax(1)
        filled[some, of] = values[some, lenders[np.arange(len(of)), first]]
    filled = filled.reshape(n, -1, BAND_ROWS)[:, :BANDS]
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (n, BANDS))
    for j in range(BAND_ROWS):
        key = mixed(key ^ filled[:, :, j])
    return key.view(np.int64)


def chance(n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """How likely the minima of different hashes have equal registers, for sets of these sizes."""
    zeros = np.arange(REST_BITS + 1)[:, None]
    held = lambda n: (1 - 0.5 ** (zeros + 1.0)) ** (n / (1 << BUCKET_BITS)) - (1 - 0.5**zeros.astype(float)) ** (n / (1 << BUCKET_BITS))
    return np.abs((held(np.asarray(n_left, float)) * held(np.asarray(n_right, float))).sum(0)) / (1 << MANTISSA_BITS)


def estimates(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of register rows, the similarity corrected for chance, and whether they can reach the threshold: by the
    sizes of their sets, which is exact, and by the estimate plus ``DEVIATIONS`` standard deviations."""
    either = ((left > 0) | (right > 0)).sum(-1)
    equal = ((left == right) & (left > 0)).sum(-1)
    by_chance = chance(n_left, n_right)
    estimate = (equal / np.maximum(either, 1) - by_chance) / (1 - by_chance)
    least = percent / 100
    union = (n_left + n_right) / (1 + least)
    undrawn = np.clip((union - either) / np.maximum(union - 1, 1), 0, 1)
    slack = (DEVIATIONS * np.sqrt(least * (1 - least) * np.maximum(either, 1) * undrawn) + 2) / np.maximum(either, 1)
    sizes = 100 * np.minimum(n_left, n_right) >= percent * np.maximum(n_left, n_right)
    return estimate, sizes & (estimate >= least - slack)


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Every row of ``docs``: row, doc_id, n_shingles, a digest of its set, and its registers."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            sets = shingle_sets(chunk.column("text"), words)
            yield pa.RecordBatch.from_pydict({
                "row": chunk.column("row"), "doc_id": chunk.column("doc_id"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "same": pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                "registers": pa.array([r.tobytes() for r in registers(sets)], pa.binary()),
            })

    return numbered(docs.select("doc_id", "text"), "row").mapInArrow(sign, "row long, doc_id long, n_shingles long, same binary, registers binary")


def full_sets(docs: DataFrame, rows: DataFrame, words: int = WORDS) -> DataFrame:
    """The whole shingle sets (row, shingles) of the rows whose numbers are in ``rows``."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            sets = [s.view(np.int64) for s in shingle_sets(chunk.column("text"), words)]
            yield pa.RecordBatch.from_pydict({"row": chunk.column("row"), "shingles": pa.array(sets, pa.list_(pa.int64()))})

    wanted = numbered(docs.select("text"), "row").join(rows, "row", "left_semi")
    return wanted.select("row", "text").mapInArrow(shingle, "row long, shingles array<bigint>")


def read_registers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<u2").reshape(len(values), -1)


def sorted_out(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of classes whose registers leave the threshold possible."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
                _, hold = estimates(read_registers(batch.column("of_a")), read_registers(batch.column("of_b")), *sizes)
                yield batch.select(["a", "b"]).filter(pa.array(hold))

    side = lambda c: classes.select(F.col("class").alias(c), F.col("registers").alias(f"of_{c}"), F.col("n_shingles").alias(f"n_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "of_a", "of_b", "n_a", "n_b").mapInArrow(estimate, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The ``pairs`` (a, b) that the full sets confirm."""
    side = lambda c: sets.select(F.col("row").alias(c), F.col("shingles").alias(f"of_{c}"))
    shared = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    either = F.size("of_a") + F.size("of_b") - F.col("shared")
    return pairs.join(side("a"), "a").join(side("b"), "b").withColumn("shared", shared).where(F.col("shared") * 100 >= either * percent).select("a", "b")


def in_groups(classes: DataFrame, links: DataFrame | None = None, placed: DataFrame | None = None) -> DataFrame:
    """Every class with the group that ``links`` (a, b) put it in, and the group's size. With ``placed``, groups made before, links
    join whole groups."""
    if placed is None:
        placed = classes.select("class", F.col("class").alias("together"))
    else:
        side = lambda c: placed.select(F.col("class").alias(c), F.col("together").alias(f"of_{c}"))
        links = links.join(side("a"), "a").join(side("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).where("a <> b")
        placed = placed.select("class", "together")
    if links is not None:
        placed = placed.join(components(links), F.col("together") == F.col("id"), "left").select("class", F.coalesce("component", "together").alias("together"))
    return placed.join(placed.groupBy("together").agg(F.count("*").alias("many")), "together")


def apart(buckets: DataFrame, placed: DataFrame, classes: DataFrame) -> DataFrame:
    """Which classes should visit which other groups: (a, together, b), b being the member of that group that looks most like a.

    A class visits a larger group (of equal ones that with the greater number) if it shares a bucket with a member that its
    registers leave possible. Buckets are compared in blocks against blocks; buckets within one group are left out.
    """
    members = buckets.select("key", "class").join(placed, "class")
    mixed_buckets = (
        members.groupBy("key").agg(F.min("together").alias("least"), F.max("together").alias("most"), F.count("*").alias("n"))
        .where("least < most").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    # A member of block i meets the blocks from i on, and as the other side those up to i. Buckets of one block share tasks.
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    first, second = F.least("own", "other"), F.greatest("own", "other")
    task = F.when(F.col("blocks") == 1, F.pmod(F.col("key"), F.lit(1 << 10))).otherwise(F.xxhash64("key", "first", "second"))
    rows = (
        members.join(mixed_buckets, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"first": first, "second": second}).withColumn("task", task).join(classes.select("class", "registers", "n_shingles"), "class")
        .select("task", "key", "first", "second", "own", "class", "together", "many", "registers", "n_shingles")
    )

    def compare(group: pa.Table) -> pa.Table:
        names = ("key", "first", "second", "own", "class", "together", "many", "n_shingles")
        key, first, second, own, name, together, many, n = (group[c].to_numpy() for c in names)
        values = read_registers(group["registers"])
        order = np.lexsort((second, first, key))
        change = np.flatnonzero(np.any([np.diff(c[order]) != 0 for c in (key, first, second)], axis=0)) + 1
        found: dict[tuple[int, int], tuple[float, int]] = {}
        for part in np.split(order, change):
            for side, other in ((first, second), (second, first)) if first[part[0]] != second[part[0]] else ((first, second),):
                hosts = part[own[part] == other[part]]
                for i in part[own[part] == side[part]]:
                    larger = (many[hosts] > many[i]) | ((many[hosts] == many[i]) & (together[hosts] > together[i]))
                    those = hosts[larger]
                    if len(those):
                        likeness, hold = estimates(values[i], values[those], n[i : i + 1], n[those])
                        for host, like in zip(those[hold].tolist(), likeness[hold].tolist()):
                            pair = int(name[i]), int(together[host])
                            found[pair] = max(found.get(pair, (-1.0, 0)), (like, int(name[host])))
        return pa.table({
            "a": pa.array([a for a, _ in found], pa.int64()), "together": pa.array([t for _, t in found], pa.int64()),
            "b": pa.array([b for _, b in found.values()], pa.int64()), "likeness": pa.array([x for x, _ in found.values()], pa.float64()),
        })

    seen = rows.groupBy("task").applyInArrow(compare, "a long, together long, b long, likeness double")
    return seen.groupBy("a", "together").agg(F.max_by("b", F.struct("likeness", "b")).alias("b"))


def met(visits: DataFrame, placed: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that the full sets confirm between the visitors and any member of the groups that they visit, ``visits``
    (a, together): one for each visitor and block of members. Both sides are dealt out in blocks of bounded size."""
    hosts = placed.join(visits.select("together").distinct(), "together", "left_semi").select("together", F.col("class").alias("row"))
    guests = visits.select("together", F.col("a").alias("row"))

    def dealt(side: DataFrame, name: str) -> DataFrame:
        counted = side.groupBy("together").agg(F.ceil(F.count("*") / MEETING).cast("int").alias(name))
        return side, counted

    (hosts, host_blocks), (guests, guest_blocks) = dealt(hosts, "host_blocks"), dealt(guests, "guest_blocks")
    counts = host_blocks.join(guest_blocks, "together")
    own = lambda blocks: F.pmod(F.xxhash64("row"), F.col(blocks)).cast("int")
    each = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    columns = ["together", "host_block", "guest_block", "visits", "row", "shingles"]
    seated = lambda side: side.join(counts, "together").join(sets, "row")
    rows = (
        seated(hosts).withColumns({"visits": F.lit(False), "host_block": own("host_blocks")}).withColumn("guest_block", each("guest_blocks")).select(columns)
        .unionByName(seated(guests).withColumns({"visits": F.lit(True), "guest_block": own("guest_blocks")}).withColumn("host_block", each("host_blocks")).select(columns))
    )

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        comes, names = group["visits"].to_numpy(zero_copy_only=False), group["row"].to_numpy()
        lists = group["shingles"].combine_chunks() if group.num_rows else group["shingles"]
        all_sets = [lists[i].values.to_numpy() for i in range(group.num_rows)]
        own_hosts, links = np.flatnonzero(~comes), []
        if len(own_hosts):
            together, sizes = np.concatenate([all_sets[i] for i in own_hosts]), np.array([len(all_sets[i]) for i in own_hosts])
            starts = np.cumsum(sizes) - sizes
            for i in np.flatnonzero(comes):
                guest = np.sort(all_sets[i])
                at = np.minimum(np.searchsorted(guest, together), len(guest) - 1)
                shared = np.add.reduceat((guest[at] == together).astype(np.int64), starts)
                hit = np.flatnonzero(100 * shared >= percent * (len(guest) + sizes - shared))
                if len(hit):
                    links.append((names[i], names[own_hosts[hit[0]]]))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return rows.groupBy("together", "host_block", "guest_block").applyInArrow(compare, "a long, b long")


def alone(classes: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the ``classes`` (class, n_shingles) that no other one of them can be linked with: of n shingles a link needs
    percent / 100 * n in common, and too many are in no other set. A task sends each of its shingles once, with the class that
    alone has it there, packed by ranges; there are as many ranges as keep one in a task's memory."""
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_SHINGLES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shingles")
            for at in range(0, batch.num_rows, SENT_CLASSES):
                some = lists.slice(at, SENT_CLASSES)
                owner = np.repeat(batch.column("row").slice(at, SENT_CLASSES).to_numpy(), some.value_lengths().to_numpy())
                shingles, first, n = np.unique(some.flatten().to_numpy(), return_index=True, return_counts=True)
                owner = np.where(n == 1, owner[first], -1)
                place = (mixed(shingles.view(np.uint64)) % np.uint64(ranges)).astype(np.int64)
                for part in np.unique(place).tolist():
                    own = place == part
                    yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "content": [pack(shingles[own], owner[own])]})

    def count(group: pa.Table) -> pa.Table:
        contents = [unpack(c) for c in group["content"].to_pylist()]
        shingles, owner = (np.concatenate([c[i] for c in contents]) for i in (0, 1))
        _, first, n = np.unique(shingles, return_index=True, return_counts=True)
        own = owner[first[n == 1]]
        names, counts = np.unique(own[own >= 0], return_counts=True)
        return pa.table({"class": pa.array(names, pa.int64()), "own": pa.array(counts, pa.int64())})

    own_sets = sets.join(classes.select(F.col("class").alias("row")), "row", "left_semi").select("row", "shingles")
    own = own_sets.mapInArrow(send, "part long, content binary").groupBy("part").applyInArrow(count, "class long, own long").groupBy("class").agg(F.sum("own").alias("own"))
    return classes.join(own, "class").where(100 * (F.col("n_shingles") - F.col("own")) < percent * F.col("n_shingles")).select("class")


def crowded_links(buckets: DataFrame, placed: DataFrame, classes: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b), confirmed on full sets, that join all groups of ``placed`` which share one of these ``buckets`` (key, class) and
    are linked there.

    In each bucket the classes outside of its largest group are guests, and all are hosts; a guest meets the hosts of larger
    groups (of equal ones those with the greater number). Both are dealt out in blocks of bounded size.
    """
    mixed_keys = lambda rows: rows.groupBy("key").agg(
        F.min("together").alias("least"), F.max("together").alias("most"), F.max(F.struct("many", "together")).alias("largest"),
    ).where("least < most")
    members = buckets.select("key", "class").join(placed, "class")
    inside = stored(members.join(mixed_keys(members).select("key"), "key"), "crowded")
    facts = classes.select("class", "n_shingles")
    lonely = stored(alone(facts.join(inside, "class", "left_semi"), sets, percent), "alone")
    rest = inside.join(lonely, "class", "left_anti")
    guest = F.struct("many", "together") < F.col("largest")
    seated = rest.join(mixed_keys(rest).select("key", "largest"), "key").withColumn("guest", guest)
    blocks = seated.groupBy("key").agg(
        F.ceil(F.count("*") / MEETING).cast("int").alias("host_blocks"), F.ceil(F.count(F.when(F.col("guest"), 1)) / MEETING).cast("int").alias("guest_blocks"),
    )
    own = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = seated.join(blocks, "key").join(classes.select("class", "n_shingles", "registers"), "class").join(sets.withColumnRenamed("row", "class"), "class")
    columns = ["visits", "class", "together", "many", "n_shingles", "registers", "shingles", F.xxhash64("key", "host_block", "guest_block").alias("task")]
    hosts = dealt.withColumns({"visits": F.lit(False), "host_block": own("host_blocks")}).withColumn("guest_block", each("guest_blocks")).select(columns)
    guests = dealt.where("guest").withColumns({"visits": F.lit(True), "guest_block": own("guest_blocks")}).withColumn("host_block", each("host_blocks")).select(columns)

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        visits, names, together, many, n = (group[c].to_numpy() for c in ("visits", "class", "together", "many", "n_shingles"))
        values, lists = read_registers(group["registers"]), group["shingles"].combine_chunks()
        all_sets = [np.sort(lists[i].values.to_numpy()) for i in range(group.num_rows)]
        root, links = {int(t): int(t) for t in together}, []

        def find(t: int) -> int:
            while root[t] != t:
                root[t] = root[root[t]]
                t = root[t]
            return t

        own_hosts = np.flatnonzero(~visits)
        for i in np.flatnonzero(visits).tolist():
            those = own_hosts[(many[own_hosts] > many[i]) | ((many[own_hosts] == many[i]) & (together[own_hosts] > together[i]))]
            if not len(those):
                continue
            likeness, hold = estimates(values[i], values[those], n[i : i + 1], n[those], percent)
            for j in those[hold][np.argsort(-likeness[hold], kind="stable")].tolist():
                mine, theirs = find(int(together[i])), find(int(together[j]))
                if mine == theirs:
                    continue
                small, large = sorted((all_sets[i], all_sets[j]), key=len)
                shared = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                if 100 * shared >= percent * (len(small) + len(large) - shared):
                    root[mine] = theirs
                    links.append((int(names[i]), int(names[j])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return hosts.unionByName(guests).groupBy("task").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the group of near duplicates it belongs to.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; the set holds the distinct shingles of ``words`` words; fewer
    words are one shingle. Null and wordless texts have no shingle and are linked with nothing. Documents are linked if 100 *
    intersection >= 80 * union. Columns: row (its number in the stored table), doc_id, n_shingles, component_id (the
    smallest doc_id that links reach, null if all are), group (a number that the rows of a group share). Rows that repeat
    are linked with each other. An empty table gives no rows. ``docs`` must be a stored table.
    """
    signed = stored(signatures(docs, words), "signatures")
    classes = stored(
        signed.where("n_shingles > 0").groupBy("same")
        .agg(F.min("row").alias("class"), F.min("doc_id").alias("least_id"), F.first("registers").alias("registers"), F.first("n_shingles").alias("n_shingles")),
        "classes",
    )

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(read_registers(batch.column("registers")))
                yield pa.RecordBatch.from_pydict({"class": pa.array(np.repeat(batch.column("class").to_numpy(), BANDS)), "key": pa.array(keys.ravel())})

    keys = classes.select("class", "registers").mapInArrow(propose, "class long, key long")
    led = keys.groupBy("key").agg(F.min("class").alias("lead"), F.count("*").alias("n")).where("n > 1").select("key", "lead", F.col("n").alias("in_key"))
    buckets = stored(keys.join(led, "key"), "buckets")
    sets = stored(full_sets(docs, buckets.select(F.col("class").alias("row")).distinct(), words), "shingle-sets")
    by_buckets = Window.partitionBy("class").orderBy(F.desc("n"), "lead")
    nearest = (
        buckets.where("class <> lead").groupBy("class", "lead").agg(F.count("*").alias("n"))
        .withColumn("place", F.row_number().over(by_buckets)).where(F.col("place") <= LEADERS).select(F.col("lead").alias("a"), F.col("class").alias("b"))
    )
    first = stored(confirmed(sorted_out(nearest, classes), sets), "links")
    placed = stored(in_groups(classes, first), "groups")
    few, crowded = buckets.where(F.col("in_key") <= CROWD), buckets.where(F.col("in_key") > CROWD)
    visits = stored(apart(few, placed, classes), "visits")
    second = stored(confirmed(visits.select("a", "b"), sets).unionByName(crowded_links(crowded, placed, classes, sets)), "links")
    now = stored(in_groups(classes, second, placed).select("class", "together"), "groups")
    # Who is still apart from a group of more than one compares itself with every member of it.
    several = placed.where("many > 1").select("together").distinct()
    group_now = placed.join(now.select("class", F.col("together").alias("theirs")), "class").groupBy("together").agg(F.min("theirs").alias("theirs"))
    open_visits = stored(
        visits.join(several, "together", "left_semi").join(now.select(F.col("class").alias("a"), F.col("together").alias("now")), "a")
        .join(group_now, "together").where("now <> theirs").select("a", "together"),
        "visits",
    )
    third = stored(met(open_visits, placed, sets), "links")
    groups = (
        classes.select("same", "class", "least_id").join(in_groups(classes, third, now).select("class", "together"), "class")
        .select("same", "least_id", F.col("together").alias("group"))
    )
    named = groups.join(groups.groupBy("group").agg(F.min("least_id").alias("component_id")), "group").select("same", "group", "component_id")
    rows = signed.select("row", "doc_id", "n_shingles", "same").join(stored(named, "groups"), "same", "left").withColumn(
        "group", F.when(F.col("n_shingles") > 0, F.col("group")).otherwise(-1 - F.col("row"))
    ).withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return rows.select("row", "doc_id", "n_shingles", "component_id", "group")


def near_digest(docs: DataFrame) -> DataFrame:
    """What became of each document."""
    return near_duplicates(docs).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each group, that with the smallest doc_id (null last, then the first), all columns kept.
    Rows without a shingle all stay. ``docs`` must be a stored table."""
    row = fresh(docs, "row")
    plan = stored(near_duplicates(docs, words), "near-duplicates")
    staying = plan.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")).select(F.col("best.row").alias("row"))
    dropped = plan.join(staying, "row", "left_anti").select(F.col("row").alias(row))
    return numbered(docs, row).join(dropped, row, "left_anti").select(*[column(c) for c in docs.columns])
