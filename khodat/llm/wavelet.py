"""Token ids as files of wavelet matrices, one file a shard, and what can be asked of them.

A shard holds the ids of whole documents in a row. Its matrix has one plane for each bit of an id, the highest first; behind each plane
the ids are parted stably, those with a 0 there before those with a 1. Ones are counted before every 512 bits, so a
place is found in the next plane (rank) or the one before (select) without reading what lies between: single ids, counts
and places of an id come from the planes alone.

A file: ``MAGIC``; how many sections, and for each its length (little-endian unsigned 64-bit integers); the sections, each compressed by
itself. The first holds bits of an id, and doc_id, whether it is null and number of ids of each document; then
follows one for each plane: how many ids have a 0, the bits as 64-bit words, and the ones before each block.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from khodat.llm.bpe import byte_letters
from khodat.llm.common import gathered_chunks, numbered, pack, stored, unpack, whole_texts
from khodat.session import scratch_path

MAGIC = b"KHOWAVE1"
#: Ids after which a shard is closed. Documents are not cut, so a shard may hold one text more than that.
SHARD_TOKENS = 1 << 22
#: About how many bytes of text make an id. It sets how many tasks write, not what they write.
TOKEN_BYTES = 3
#: Words whose ids a worker keeps, the first that it meets. It saves work and changes no result.
KEPT_WORDS = 350_000
#: Words given to the tokenizer at once.
ENCODED_TOGETHER = 20_000
BLOCK_WORDS = 8
#: In regular expressions, letters, and the signs and digits of ASCII, but for the signs at which special tokens begin or end.
LATIN = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}"
SIGNS = r"!-;=?@\[-`{}~"


class Plane:
    """Bits with rank and select, for arrays of places at a time."""

    def __init__(self, words: np.ndarray, blocks: np.ndarray):
        ones = np.bitwise_count(words).astype(np.int64).reshape(-1, BLOCK_WORDS)
        self.words = words
        self.before = (np.cumsum(ones, 1) - ones + blocks.astype(np.int64)[:, None]).ravel()

    @staticmethod
    def parts(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bits as words, with one bit at least to spare, and the ones before each block."""
        words = np.zeros((len(bits) // (64 * BLOCK_WORDS) + 1) * BLOCK_WORDS, "<u8")
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(words).reshape(-1, BLOCK_WORDS).sum(1, dtype=np.int64)
        return words, (np.cumsum(ones) - ones).astype("<u8")

    def bits(self, n: int) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=n, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & below)

    def select(self, which: np.ndarray, bit: bool) -> np.ndarray:
        """The places of the ones, or zeros, with these numbers (from 0)."""
        before = self.before if bit else 64 * np.arange(len(self.words)) - self.before
        word = np.searchsorted(before, which, "right") - 1
        bits = np.unpackbits(self.words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") == bit
        return 64 * word + (np.cumsum(bits, 1) > (which - before[word])[:, None]).argmax(1)


class Shard:
    """The content of a file. Sections are unpacked when they are first needed."""

    def __init__(self, content: bytes):
        if content[: len(MAGIC)] != MAGIC:
            raise ValueError("not a shard of token ids")
        at = len(MAGIC)
        count = int.from_bytes(content[at : at + 8], "little")
        lengths = np.frombuffer(content, "<u8", count, at + 8).astype(np.int64)
        ends = at + 8 + 8 * count + np.cumsum(lengths)
        self._sections = [content[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist())]
        (self._bits,), self.doc_ids, self.no_id, lengths = unpack(self._sections[0])
        #: Where each document's ids start (one more than there are documents).
        self.starts = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
        self._planes: dict[int, tuple[int, Plane]] = {}

    def __len__(self) -> int:
        return int(self.starts[-1])

    @staticmethod
    def content(doc_ids: np.ndarray, no_id: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
        """The file of documents (ids 0 where ``no_id``) whose ``ids`` lie in a row."""
        bits = max(int(ids.max()).bit_length(), 1) if len(ids) else 1
        sections = [pack(np.array([bits], "<i8"), doc_ids.astype("<i8"), no_id.astype("<u1"), lengths.astype("<i8"))]
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for bit in range(bits - 1, -1, -1):
            ones = (now & now.dtype.type(1 << bit)) != 0
            zeros = now[np.flatnonzero(~ones)]
            sections.append(pack(np.array([len(zeros)], "<i8"), *Plane.parts(ones)))
            now = np.concatenate([zeros, now[np.flatnonzero(ones)]])
        sizes = np.array([len(sections), *map(len, sections)], "<u8")
        return b"".join([MAGIC, sizes.tobytes(), *sections])

    def planes(self) -> Iterator[tuple[int, int, Plane]]:
        """Each bit of an id, highest first, with the number of ids that have a 0 there, and its plane."""
        for i in range(int(self._bits)):
            if i not in self._planes:
                (zeros,), words, blocks = unpack(self._sections[1 + i])
                self._planes[i] = int(zeros), Plane(words, blocks)
            yield int(self._bits) - 1 - i, *self._planes[i]

    def all_ids(self) -> np.ndarray:
        """All ids in their order: from the last plane back to the first, ids that were parted are put together again."""
        n = len(self)
        ids = np.zeros(n, np.uint16 if int(self._bits) <= 16 else np.uint32)
        for bit, zeros, plane in reversed(list(self.planes())):
            ones, before = plane.bits(n), np.empty_like(ids)
            before[np.flatnonzero(~ones)] = ids[:zeros]
            before[np.flatnonzero(ones)] = ids[zeros:] | ids.dtype.type(1 << bit)
            ids = before
        return ids.astype(np.uint32)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at these places."""
        at, ids = np.asarray(at, np.int64), np.zeros(len(at), np.uint32)
        for _, zeros, plane in self.planes():
            ones, before = plane.get(at), plane.rank(at)
            at = np.where(ones, zeros + before, at - before)
            ids = ids << 1 | ones
        return ids

    def _span(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` between two places lie behind the last plane."""
        span = np.array([start, end])
        if not 0 <= token < 1 << int(self._bits):
            return 0, 0
        for bit, zeros, plane in self.planes():
            before = plane.rank(span)
            span = zeros + before if token >> bit & 1 else span - before
        return int(span[0]), int(span[1])

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often ``token`` occurs between two places."""
        low, high = self._span(token, start, len(self) if end is None else end)
        return high - low

    def occurrences(self, token: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """The places of ``token`` between two places, ascending."""
        at = np.arange(*self._span(token, start, len(self) if end is None else end))
        if len(at):
            for bit, zeros, plane in reversed(list(self.planes())):
                one = bool(token >> bit & 1)
                at = plane.select(at - zeros if one else at, one)
        return at

    def document_of(self, at: np.ndarray) -> np.ndarray:
        """The number, within the shard, of the document at these places."""
        return np.searchsorted(self.starts, at, "right") - 1


class WordEncoder:
    """The tokenizers library over words between ASCII white space, each distinct word of a chunk encoded once.

    ``definition`` lower-cases, drops white space and parts letters from signs. No piece, special token or composed letter
    reaches across white space, nor from a Latin letter to the ASCII signs and digits that end a word.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        steps = [n["type"] for n in parts["normalizer"]["normalizers"]]
        pattern = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if steps != ["NFC", "Replace", "Lowercase"] or not pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"):
            raise ValueError(f"not a definition of this kind: {steps}, {pattern}")
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize, letters = self.tokenizer.model.tokenize, byte_letters()
        self.letters = {c: "".join([letters[b] for b in chr(c).lower().encode()]) for c in range(256) if chr(c).isalpha()}
        self.signs = sorted({t["content"][0] for t in parts["added_tokens"]})
        # Words whose ids are kept, and the ids.
        self.known = pa.array([], pa.large_string())
        self.ids, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def encoded(self, words: list[str]) -> tuple[list[int], list[int], list[int]]:
        """The words' numbers in the order in which they are encoded; their ids in a row, and how many each has."""
        # Latin letters alone are one piece, composed already, which the model takes by the letters of its bytes.
        pieces = [i for i, w in enumerate(words) if w.isalpha() and (w.isascii() or max(w) <= "ÿ")]
        ids, lengths = [], []
        for at in range(0, len(pieces), ENCODED_TOGETHER):
            found = [self.tokenize(words[i].translate(self.letters)) for i in pieces[at : at + ENCODED_TOGETHER]]
            ids += [t.id for tokens in found for t in tokens]
            lengths += map(len, found)
        left = np.ones(len(words), bool)
        left[pieces] = False
        others = np.flatnonzero(left).tolist()
        for at in range(0, len(others), ENCODED_TOGETHER):
            for coded in self.tokenizer.encode_batch_fast([words[i] for i in others[at : at + ENCODED_TOGETHER]], add_special_tokens=False):
                own = coded.ids
                ids += own
                lengths.append(len(own))
        return pieces + others, ids, lengths

    def words(self, words: pa.Array, end: int) -> tuple[pa.LargeListArray, np.ndarray]:
        """Lists of ids, and the number of the list of each of these different words; the last list is ``end`` alone."""
        found = pc.index_in(words, value_set=self.known)
        number = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = words.filter(found.is_null())
        order, ids, lengths = self.encoded(new.to_pylist())
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        number[number < 0] = len(self.known) + rank
        all_ids, all_lengths = np.concatenate([self.ids, np.array(ids, np.uint32)]), np.concatenate([self.lengths, np.array(lengths, np.int64)])
        offsets = np.concatenate([[0], np.cumsum(all_lengths), [len(all_ids) + 1]])
        lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(np.append(all_ids, np.uint32(end)), pa.uint32()))
        # Frequent words come early and stay.
        if room := min(KEPT_WORDS - len(self.known), len(order)):
            self.known = pa.concat_arrays([self.known, new.take(pa.array(np.array(order[:room], np.int64)))])
            self.lengths = all_lengths[: len(self.known)]
            self.ids = all_ids[: offsets[len(self.known)]]
        return lists, number

    def encode_texts(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with ``end`` behind it, and how many each text has. Null is empty."""
        whole = whole_texts(texts)
        # Words that differ in case or in the signs and digits behind them are encoded once. A special token keeps its case.
        plain = pc.ascii_lower(whole)
        for sign in self.signs:
            plain = pc.if_else(pc.match_substring(whole, sign), whole, plain)
        plain = pc.replace_substring_regex(plain, f"([{LATIN}])([{SIGNS}]+)([\\x20\\x09-\\x0D]|$)", r"\1 \2\3")
        lists = pc.ascii_split_whitespace(plain)
        starts = np.asarray(lists.offsets, np.int64)
        coded = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        words, number = self.words(coded.dictionary, end)
        which = np.insert(number[coded.indices.to_numpy(zero_copy_only=False)], starts[1:] - starts[0], len(words) - 1)
        ids = words.take(pa.array(which))
        ends = np.asarray(ids.offsets)
        return ids.values.to_numpy()[ends[0] : ends[-1]], np.diff(ends[starts - starts[0] + np.arange(len(starts))])


_ready: dict[str, WordEncoder] = {}


def _opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_file(uri: str, content: bytes) -> None:
    """The file appears whole or not at all: a task that is repeated, or runs twice, writes the same once more."""
    system, path = _opened(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    own = f"{path}.{os.urandom(8).hex()}"
    with system.open_output_stream(own) as file:
        file.write(content)
    system.move(own, path)


def read_file(uri: str) -> Shard:
    system, path = _opened(uri)
    with system.open_input_stream(path) as file:
        return Shard(file.read())


def write_shards(docs: DataFrame, definition: str, end: int, folder: str | None = None, most: int = SHARD_TOKENS) -> DataFrame:
    """Encodes the whole texts of ``docs`` (doc_id, text), puts ``end`` behind each, and writes them as shards to ``folder``.

    Documents lie in ascending doc_id order, null first; rows that share one lie in the order of the stored table. A
    null text is empty and has the end id alone. Returns the list of shards, one row for a file: uri, n_docs, n_ids, start (ids of
    all files before it). An empty table gives none. ``definition`` is the path of the tokenizer's file on the driver;
    ``folder`` must be one that all executors reach (by default a new one below the shared folder). ``docs`` must be a stored
    table. Texts are exchanged once, by range of doc_id; rows that share a doc_id may lie in several ranges.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-ids")
    with open(definition, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-size // (most * TOKEN_BYTES)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if content.value not in _ready:
            _ready[content.value] = WordEncoder(content.value)
        part, number, waiting, total = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            ids, no_id, rows, lengths, tokens = (np.concatenate(c) for c in zip(*waiting))
            uri = f"{folder}/{part:07d}-{number:05d}.wave"
            write_file(uri, Shard.content(ids, no_id, lengths, tokens))
            first = None if no_id[0] else int(ids[0])
            return pa.RecordBatch.from_pydict({
                "uri": [uri], "n_docs": pa.array([len(ids)], pa.int64()), "n_ids": pa.array([len(tokens)], pa.int64()),
                "first_id": pa.array([first], pa.int64()), "first_row": pa.array([int(rows[0])], pa.int64()),
            })

        for chunk in gathered_chunks(batches):
            ids, lengths = _ready[content.value].encode_texts(chunk.column("text"), end)
            doc_id = chunk.column("doc_id")
            waiting.append((
                pc.fill_null(doc_id, 0).to_numpy(zero_copy_only=False), doc_id.is_null().to_numpy(zero_copy_only=False),
                chunk.column("row").to_numpy(), lengths, ids,
            ))
            total += len(ids)
            if total >= most:
                yield close()
                number, waiting, total = number + 1, [], 0
        if waiting:
            yield close()

    order = [F.asc_nulls_first("doc_id"), F.asc("row")]
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "row")
    written = stored(
        rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        .mapInArrow(write, "uri string, n_docs long, n_ids long, first_id long, first_row long"),
        "shards",
    )
    before = Window.orderBy(F.asc_nulls_first("first_id"), "first_row").rowsBetween(Window.unboundedPreceding, -1)
    return stored(written.select("uri", "n_docs", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")), "shards")


def _each_file(shards: DataFrame) -> DataFrame:
    """The list dealt out evenly: its rows are small, the files they name are not."""
    return shards.repartition(max(1, min(shards.count(), 1 << 15)), F.xxhash64("uri"))


def documents_in(shards: DataFrame, ids: bool = False) -> DataFrame:
    """Every document of the ``shards`` (as ``write_shards`` lists them), read from their files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), and the ids if wanted."""
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist()):
                shard = read_file(uri)
                tokens = memoryview(shard.all_ids().astype("<u4").tobytes())
                bounds = list(zip((4 * shard.starts[:-1]).tolist(), (4 * shard.starts[1:]).tolist()))
                columns = {
                    "doc_id": pa.array(shard.doc_ids, pa.int64(), mask=shard.no_id.astype(bool)),
                    "start": pa.array(start + shard.starts[:-1]), "n_tokens": pa.array(np.diff(shard.starts)),
                    "ids_crc32": pa.array([zlib.crc32(tokens[a:b]) for a, b in bounds], pa.int64()),
                }
                if ids:
                    columns["ids"] = pa.array([bytes(tokens[a:b]) for a, b in bounds], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return _each_file(shards).select("uri", "start").mapInArrow(read, kind)


def occurrences_in(shards: DataFrame, token: int) -> DataFrame:
    """The documents that hold ``token``, from the planes alone: doc_id, start (of the document), n (how often), first (its first
    place in the document)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist()):
                shard = read_file(uri)
                places = shard.occurrences(token)
                which, first, n = np.unique(shard.document_of(places), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(shard.doc_ids[which], pa.int64(), mask=shard.no_id[which].astype(bool)),
                    "start": pa.array(start + shard.starts[which]), "n": pa.array(n, pa.int64()),
                    "first": pa.array(places[first] - shard.starts[which], pa.int64()),
                })

    return _each_file(shards).select("uri", "start").mapInArrow(find, "doc_id long, start long, n long, first long")


def token_count(shards: DataFrame, token: int) -> int:
    """How often ``token`` occurs in all shards, from rank alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([read_file(uri).count(token) for uri in batch.column("uri").to_pylist()], pa.int64())})

    return _each_file(shards).select("uri").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


def token_digest(docs: DataFrame, definition: str, end: int = 2) -> DataFrame:
    """Every document as its shard's file gives it back: doc_id, start, n_tokens, ids_crc32."""
    return documents_in(write_shards(docs, definition, end))
