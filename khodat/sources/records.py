"""Records of CSV files whose quoted fields hold line breaks, read by many tasks for each file.

A line break ends a record where the quotes before it in the file are even in number. How many lie in each split of a
file is counted first; sums over the splits before it tell each task whether its split begins within quotes. The
task then joins lines to records. Only what lies across a split's edge, two pieces a split at most, is exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMPLETE, HEAD, TAIL = 0, 1, 2
_PIECES = "path string, start long, kind int, first boolean, closed boolean, record string"


class _Split:
    """Joins the lines of one split, batch by batch."""

    def __init__(self, path: str, start: int, inside: bool):
        self.path, self.start, self.inside = path, start, inside
        # Lines of the record that is open. One that was open when the split began is its head.
        self.open: list[str] = []
        self.kind, self.records = HEAD if inside else COMPLETE, 0

    def _rows(self, kind: int, closed: bool, texts: pa.Array, first: list[bool]) -> pa.RecordBatch:
        n = len(texts)
        columns = [
            pa.repeat(pa.scalar(self.path), n), pa.repeat(pa.scalar(self.start, pa.int64()), n), pa.repeat(pa.scalar(kind, pa.int32()), n),
            pa.array(first), pa.repeat(pa.scalar(closed), n), texts.cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["path", "start", "kind", "first", "closed", "record"])

    def _begins_file(self) -> bool:
        return self.start == 0 and self.records == 0

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        inside = (int(self.inside) + np.cumsum(quotes)) % 2 == 1
        ends = np.flatnonzero(~inside)
        self.inside = bool(inside[-1]) if len(inside) else self.inside
        if not len(ends):
            self.open += lines.to_pylist()
            return
        if self.open or self.kind == HEAD:
            text = "\n".join([*self.open, *lines.slice(0, ends[0] + 1).to_pylist()])
            yield self._rows(self.kind, True, pa.array([text]), [self._begins_file()])
            self.records += 1
            ends, at, self.open, self.kind = ends[1:], int(ends[0]) + 1, [], COMPLETE
        else:
            at = 0
        begins = np.concatenate([[at], ends[:-1] + 1])[: len(ends)]
        own = lines.take(pa.array(ends))
        several = np.flatnonzero(ends > begins)
        if len(several):
            whole = ["\n".join(lines.slice(b, e - b + 1).to_pylist()) for b, e in zip(begins[several].tolist(), ends[several].tolist())]
            mask = np.zeros(len(ends), bool)
            mask[several] = True
            own = pc.replace_with_mask(own.cast(pa.large_string()), pa.array(mask), pa.array(whole, pa.large_string()))
        if len(ends):
            yield self._rows(COMPLETE, True, own, [self._begins_file(), *[False] * (len(ends) - 1)])
            self.records += len(ends)
            at = int(ends[-1]) + 1
        self.open = lines.slice(at).to_pylist()

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.kind == HEAD:
            yield self._rows(HEAD, False, pa.array(["\n".join(self.open)]), [False])
        elif self.open:
            yield self._rows(TAIL, False, pa.array(["\n".join(self.open)]), [self._begins_file()])


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The records of the CSV files at ``path`` as one text column, ``record``, without headers and empty lines.

    Quotes stand around fields only, and are doubled within one, as RFC 4180 says. A file that ends within quotes raises
    when it is read. Line breaks are line feeds, with or without a carriage return before them; within quotes they stay as
    they are. Large files are read by several tasks, compressed ones by one each. The files are read twice; the driver
    keeps one number for each split, of which its own list of splits holds more.
    """
    own = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", own["file_path"].alias("path"), own["file_block_start"].alias("start"),
    )
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"')))).alias("quotes")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("path", "start").agg(quotes).select("path", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    begins = spark.sparkContext.broadcast({(r.path, r.start): r.inside for r in splits.collect()})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            if not batch.num_rows:
                continue
            paths, starts = (batch.column(c).dictionary_encode() for c in ("path", "start"))
            place = paths.indices.to_numpy().astype(np.int64) << 32 | starts.indices.to_numpy()
            for run in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(place)) + 1):
                key = batch.column("path")[run[0]].as_py(), batch.column("start")[run[0]].as_py()
                if split is None or (split.path, split.start) != key:
                    if split is not None:
                        yield from split.end()
                    if key not in begins.value:
                        raise ValueError(f"the splits of {key[0]} have changed while it was read; read it again")
                    split = _Split(*key, begins.value[key])
                yield from split.add(batch.column("value").slice(int(run[0]), len(run)))
        if split is not None:
            yield from split.end()

    pieces = lines.mapInArrow(join, _PIECES)
    edges = pieces.where(F.col("kind") != COMPLETE)
    in_order = Window.partitionBy("path").orderBy("start", "kind")
    numbered = edges.withColumn("number", F.sum((F.col("kind") == TAIL).cast("int")).over(in_order))
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("parts")
    glued = numbered.groupBy("path", "number").agg(parts, F.max("first").alias("first"), F.max("closed").alias("closed")).select(
        F.col("first"),
        F.when(F.col("closed"), F.array_join(F.transform("parts", lambda p: p["record"]), "\n"))
        .otherwise(F.raise_error(F.concat(F.lit("a quoted field is open at the end of "), F.col("path")))).alias("record"),
    )
    whole = pieces.where(F.col("kind") == COMPLETE).select("first", "record").unionByName(glued)
    kept = whole.where(~F.col("first")) if header else whole
    return kept.select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")
