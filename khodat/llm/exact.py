"""Exact duplicates: counting quotient filters find fingerprints seen more than once, and only their texts are compared.

The leading bits of a 64-bit fingerprint name a range, the next ones (the quotient) a run of its filter, and the others (the
remainder) stand sorted in that run with a count. So fingerprints are held whole, and filters over parts of the data merge
without loss, by walking their sorted remainders. Each task builds one filter for each range it meets, and the filters of a
range are merged in one task. A filter has the same number of runs however large the table is. Equal
fingerprints collapse to a count before they travel, so a text that fills a third of the table weighs no more than any
other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khodat.llm.common import column, fresh, narrow, numbered, pack, stored, unpack

#: The characters [\x20\x09-\x0D] (fixed values).
WHITE = " \t\n\x0b\x0c\r"
#: Fingerprints in one range of all filters, on average.
RANGE_ROWS = 1 << 18
#: Leading bits below the range that name a run.
RUN_BITS = 12


@dataclass
class CountingQuotientFilter:
    """Distinct fingerprints below 2 ** ``width`` with counts. ``runs[q]`` is where the run of quotient q starts; there are 2 ** ``bits`` runs,
    however large the table is."""

    bits: int
    width: int
    runs: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None, bits: int = RUN_BITS, width: int = 64) -> CountingQuotientFilter:
        """Sorts the fingerprints and adds up the counts of equal ones (1 each without ``counts``)."""
        distinct, place = np.unique(fingerprints.astype(np.uint64), return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, place, 1 if counts is None else counts.astype(np.int64))
        return cls.of_sorted(distinct, totals, bits, width)

    @classmethod
    def of_sorted(cls, distinct: np.ndarray, counts: np.ndarray, bits: int, width: int) -> CountingQuotientFilter:
        quotients = (distinct >> np.uint64(width - bits)).astype(np.int64)
        runs = np.r_[0, np.cumsum(np.bincount(quotients, minlength=1 << bits))]
        return cls(bits, width, runs, distinct & np.uint64((1 << (width - bits)) - 1), counts)

    def fingerprints(self) -> np.ndarray:
        quotients = np.repeat(np.arange(len(self.runs) - 1, dtype=np.uint64), np.diff(self.runs))
        return (quotients << np.uint64(self.width - self.bits)) | self.remainders

    def joined(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Both together. The sorted remainders of ``other`` find their places in the sorted runs here: equal ones add their
        counts, the others move in, and the runs behind them shift."""
        own, new = self.fingerprints(), other.fingerprints()
        at = np.searchsorted(own, new)
        equal = np.zeros(len(new), bool)
        inside = at < len(own)
        equal[inside] = own[at[inside]] == new[inside]
        counts = self.counts.copy()
        counts[at[equal]] += other.counts[equal]
        moves = ~equal
        quotients = (new[moves] >> np.uint64(self.width - self.bits)).astype(np.int64)
        shifts = np.r_[0, np.cumsum(np.bincount(quotients, minlength=1 << self.bits))]
        return CountingQuotientFilter(
            self.bits, self.width, self.runs + shifts, np.insert(self.remainders, at[moves], other.remainders[moves]),
            np.insert(counts, at[moves], other.counts[moves]),
        )

    @classmethod
    def merge(cls, filters: Iterable[CountingQuotientFilter]) -> CountingQuotientFilter:
        """The filter of all fingerprints together; nothing is lost, whatever the order. Filters of about equal size are
        joined first, so few are held at a time and each remainder moves a logarithmic number of times."""
        waiting: list[CountingQuotientFilter] = []
        for one in filters:
            waiting.append(one)
            while len(waiting) > 1 and len(waiting[-2].remainders) <= 2 * len(waiting[-1].remainders):
                last = waiting.pop()
                waiting[-1] = waiting[-1].joined(last)
        while len(waiting) > 1:
            last = waiting.pop()
            waiting[-1] = waiting[-1].joined(last)
        return waiting[0]

    def count(self, fingerprint: int) -> int:
        rest = self.width - self.bits
        q, r = fingerprint >> rest, np.uint64(fingerprint & ((1 << rest) - 1))
        run = self.remainders[self.runs[q] : self.runs[q + 1]]
        at = int(np.searchsorted(run, r))
        return int(self.counts[self.runs[q] + at]) if at < len(run) and run[at] == r else 0

    def repeated(self) -> np.ndarray:
        return self.fingerprints()[self.counts > 1]

    def to_bytes(self) -> bytes:
        return pack(np.array([self.bits, self.width]), narrow(np.diff(self.runs)), self.remainders, narrow(self.counts))

    @classmethod
    def from_bytes(cls, value: bytes) -> CountingQuotientFilter:
        shape, lengths, remainders, counts = unpack(value)
        return cls(int(shape[0]), int(shape[1]), np.r_[0, np.cumsum(lengths, dtype=np.int64)], remainders, counts.astype(np.int64))


def range_filters(fingerprints: np.ndarray, range_bits: int) -> Iterator[tuple[int, CountingQuotientFilter]]:
    """A filter for each range of fingerprints, named by their leading ``range_bits``; it holds the bits below those."""
    distinct, counts = np.unique(fingerprints, return_counts=True)
    width = 64 - range_bits
    ranges, starts = np.unique(distinct >> np.uint64(width), return_index=True)
    below = distinct & np.uint64((1 << width) - 1)
    for r, a, b in zip(ranges.tolist(), starts.tolist(), [*starts[1:].tolist(), len(distinct)]):
        yield r, CountingQuotientFilter.of_sorted(below[a:b], counts[a:b], RUN_BITS, width)


def repeated_fingerprints(rows: DataFrame, n: int) -> DataFrame:
    """The fingerprints (column fp, a long) that stand in more than one of the ``n`` rows."""
    range_bits = max(n // RANGE_ROWS, 7).bit_length()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches if b.num_rows]
        if not parts:
            return
        for r, part in range_filters(np.concatenate(parts), range_bits):
            yield pa.RecordBatch.from_pydict({"range": pa.array([r]), "filter": pa.array([part.to_bytes()], pa.binary())})

    def merge(group: pa.Table) -> pa.Table:
        whole = CountingQuotientFilter.merge(CountingQuotientFilter.from_bytes(v.as_py()) for v in group["filter"])
        leading = np.uint64(group["range"][0].as_py()) << np.uint64(whole.width)
        return pa.table({"fp": pa.array((whole.repeated() | leading).view(np.int64))})

    return (
        rows.select("fp").mapInArrow(build, "range long, filter binary").groupBy("range").applyInArrow(merge, "fp long")
    )


def duplicate_plan(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the row that stays for it.

    Texts are equal when they are identical without the characters ``[\\x20\\x09-\\x0D]``; null counts as empty, and
    empty texts equal each other. The row with the most code points in its text stays, then the one with the smallest
    doc_id (null last), then the first in the stored table: one row of a group, even when rows repeat. Columns: row (its
    number in the stored table), doc_id, keep_id, group_size, kept, text_sha256. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.translate(text, WHITE, "")
    rows = stored(
        numbered(
            docs.select(
                "doc_id", F.length(text).alias("points"), F.xxhash64(bare).alias("fp"), F.unhex(F.sha2(bare, 256)).alias("sha"),
            ),
            "row",
        ),
        "fingerprints",
    )
    suspects = stored(repeated_fingerprints(rows, rows.count()), "repeated-fingerprints")
    # The texts of suspects are grouped as bytes. Copies collapse where they are read, before anything is sent.
    best = F.struct((-F.col("points")).alias("fewest"), F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    groups = (
        numbered(docs.select("doc_id", "text"), "row")
        .select("doc_id", "row", F.length(text).alias("points"), bare.alias("bare"), F.xxhash64(bare).alias("fp"))
        .join(suspects, "fp", "left_semi")
        .groupBy("bare").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
        .select(F.unhex(F.sha2("bare", 256)).alias("sha"), "best", "group_size")
    )
    stays = F.col("best.row") == F.col("row")
    return rows.join(groups, "sha", "left").select(
        "row", "doc_id", F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.coalesce(stays, F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept. ``docs`` must be a stored table."""
    row = fresh(docs, "row")
    dropped = duplicate_plan(docs).where(~F.col("kept")).select(F.col("row").alias(row))
    return numbered(docs, row).join(dropped, row, "left_anti").select(*[column(c) for c in docs.columns])
