"""Helpers that several operators share: stored intermediates, row numbers, words, hashes, packed arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from khodat.session import scratch_path

#: Text that one step of a Python worker handles at a time; bounds its memory whatever the batch size.
CHUNK_BYTES = 8 << 20

#: Odd multipliers for mixing, from the golden ratio and from splitmix64 (fixed values).
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read again: later jobs neither recompute it nor depend on the
    executors that made it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name: str) -> Column:
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """Every row with a number of its own. The numbers are the same each time as long as ``docs`` is a stored table:
    they come from the place of the row in its files."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def mixed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit integers spread evenly (the finaliser of splitmix64)."""
    z = values + GOLDEN
    z = (z ^ (z >> np.uint64(30))) * MIX_1
    z = (z ^ (z >> np.uint64(27))) * MIX_2
    return z ^ (z >> np.uint64(31))


def text_chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in order, in slices of about ``most`` bytes of text. A longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)


def gathered_chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in order, in chunks of up to ``most`` bytes of text that reach across batches. A longer
    text is a chunk of its own."""
    waiting, total = [], 0
    for chunk in text_chunks(batches, text, most):
        size = pc.sum(pc.binary_length(chunk.column(text))).as_py() or 0
        if waiting and total + size > most:
            yield pa.concat_batches(waiting)
            waiting, total = [], 0
        waiting.append(chunk)
        total += size
    if waiting:
        yield pa.concat_batches(waiting)


def whole_texts(texts: pa.Array) -> pa.Array:
    """The texts, null as empty, in buffers of their own: Arrow's text functions go wrong on slices of large strings."""
    own = texts.take(pa.array(np.arange(len(texts)), pa.int64()))
    return pc.fill_null(own.cast(pa.large_string()), "")


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text with A-Z lower-cased; null is the empty text.

    Returns where each text's words start (one more than there are texts), the words as numbers, and the words
    these numbers stand for.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(whole_texts(texts)))
    starts = np.asarray(lists.offsets, dtype=np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0])
    starts = starts - starts[0]
    # White space at either end of a text leaves an empty word there.
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not real.all():
        starts = np.concatenate([[0], np.cumsum(real)])[starts]
        flat = flat.filter(pa.array(real))
    coded = flat.dictionary_encode()
    return starts, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one dimension as one compressed value; ``unpack`` gives them back."""
    out = bytearray()
    for a in arrays:
        a = np.ascontiguousarray(a)
        out += a.dtype.str.encode().ljust(4) + len(a).to_bytes(8, "little") + a.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(bytes(out))


def unpack(value: bytes) -> list[np.ndarray]:
    raw, at, arrays = zstandard.ZstdDecompressor().decompress(value), 0, []
    while at < len(raw):
        kind, n = np.dtype(raw[at : at + 4].strip().decode()), int.from_bytes(raw[at + 4 : at + 12], "little")
        at += 12
        arrays.append(np.frombuffer(raw, kind, n, at))
        at += n * kind.itemsize
    return arrays


def narrow(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in the smallest unsigned type that holds them."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.min_scalar_type(top))
