"""Tokens of two tokenizers aligned by the bytes they cover.

A's and B's tokens of a text are intervals of the same bytes. Sorted together by start, with the running maximum of
their ends, they fall into groups: a new one begins where a start reaches the maximum, which is where tokens of both
end. Within a group those tokens are linked whose intervals overlap.

Neither tokenizer has a token that reaches across a single space between two letters or signs, so a text's words, each with the
space before it, are encoded and aligned by themselves: once for all their occurrences in a chunk of documents. Counts
of linked ids are summed over a chunk before they are sent, and each chunk is told the sums of its own pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from khodat.llm.bpe import byte_letters
from khodat.llm.common import gathered_chunks, narrow, pack, stored, unpack, whole_texts

#: Text of the documents that share one list of words; a longer text has one of its own. It changes no result.
CHUNK_BYTES = 4 << 20
#: Words whose tokens a worker keeps, the first that it meets. It saves work and changes no result.
KEPT_WORDS = 100_000
#: Words given to the tokenizers at once.
ENCODED_TOGETHER = 4_000

#: Between words: one space, and no white space on either side of it.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
SPACE_LETTER = "▁"


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all runs, each of ``lengths`` from ``starts`` on, in a row."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` with these lengths, which may be 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def coalesced(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of intervals by start, and by side where starts are equal, and the number of the group of each in that order."""
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(breaks, dtype=starts.dtype) - 1


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (of A, of B) of intervals that overlap. Those of each side are in order and do not overlap one another."""
    first = np.searchsorted(b_ends, a_starts, "right")
    many = np.searchsorted(b_starts, a_ends, "left") - first
    return np.repeat(np.arange(len(a_starts), dtype=a_starts.dtype), many), spread(first, many).astype(a_starts.dtype)


class Words:
    """Words, each with a space before it, aligned: for each word the numbers of its tokens, groups and links, the text of its
    groups, and whether both tokenizers give back its bytes (else it has no tokens)."""

    def __init__(self, tokens: list[tuple[bytes, bytes]], a_sizes: np.ndarray, b_sizes: np.ndarray):
        """``tokens`` of each word: A's and B's ids, four bytes each, or none of either."""
        self.n_a, self.n_b = (np.array([len(t[side]) >> 2 for t in tokens], np.int64) for side in (0, 1))
        self.a, self.b = (np.frombuffer(b"".join([t[side] for t in tokens]), "<i4") for side in (0, 1))
        self.good = self.n_a > 0
        # The words lie one behind the other on one line of bytes, which both sides cover without gaps.
        place = np.int64 if a_sizes[self.a].sum() >= 1 << 31 else np.int32
        a_ends, b_ends = np.cumsum(a_sizes[self.a], dtype=place), np.cumsum(b_sizes[self.b], dtype=place)
        a_starts, b_starts = a_ends - a_sizes[self.a].astype(place), b_ends - b_sizes[self.b].astype(place)
        n = len(self.a)
        side = np.repeat(np.array([0, 1], np.int8), [n, len(self.b)])
        order, group = coalesced(np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends]), side)
        of = np.empty(len(order), place)
        of[order] = group
        self.group_ends = a_ends[np.diff(of[:n], append=-1) != 0]
        self.n_groups = sums(np.diff(of[:n], prepend=-1) != 0, self.n_a)
        self.link_a, self.link_b = overlaps(a_starts, a_ends, b_starts, b_ends)
        self.n_links = sums(np.bincount(self.link_a, minlength=n), self.n_a)
        self._side, self._of = side, of

    def texts(self) -> list[str]:
        """The groups of each word: ``a1,a2|b1;`` and so on, decimal ids in order."""
        place = 2 * self._of + self._side
        order = np.argsort(place, kind="stable")
        last = np.diff(place[order], append=-1) != 0
        kind = 3 * np.concatenate([self.a, self.b])[order] + np.where(last, 1 + self._side[order], 0)
        kinds, which = np.unique(kind, return_inverse=True)
        pieces = np.array([f"{k // 3}{',|;'[k % 3]}" for k in kinds.tolist()], object)[which].tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(pieces[s:e]) for s, e in zip([0, *ends], ends)]


class Aligner:
    """Two tokenizers: A a byte-level one (``definition``, the JSON text of its file), B of pieces with a letter for the space (``model``,
    the content of its file)."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        before = parts["pre_tokenizer"]
        if parts["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True):
            raise ValueError("not a definition of this kind")
        self.a = Tokenizer.from_str(definition)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            # A special token's string is no row of byte letters, and no text is encoded to it.
            self.a_bytes[i] = bytes(byte_of.get(c, 63) for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_LETTER, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        #: Whether no piece reaches from a word into the space behind it.
        self.splits = not any(SPACE_LETTER in p.lstrip(SPACE_LETTER) for p in pieces)
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return BETWEEN.split(text) if self.splits else [text]

    def words_of(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Different words, the numbers of all texts' words in a row, and how many each text has. Null is empty."""
        whole = whole_texts(texts)
        lists = pc.split_pattern(whole, " ")
        starts = np.asarray(lists.offsets, np.int64)
        coded = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        words, which, counts = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), np.diff(starts)
        # Where no part is empty or has white space at an end, the spaces are all between words.
        odd = np.array([not (self.splits and w and not w[0].isspace() and not w[-1].isspace()) for w in words], bool)
        others = np.flatnonzero(sums(odd[which], counts))
        if len(others):
            number = {w: i for i, w in enumerate(words)}
            parts = np.split(which, np.cumsum(counts)[:-1])
            for i in others.tolist():
                parts[i] = np.array([number.setdefault(w, len(number)) for w in self.split(whole[i].as_py())], which.dtype)
            words, which, counts = list(number), np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return words, which, counts

    def align(self, words: list[str]) -> Words:
        out = [self.known.get(w) for w in words]
        new = [i for i, tokens in enumerate(out) if tokens is None]
        for at in range(0, len(new), ENCODED_TOGETHER):
            some = new[at : at + ENCODED_TOGETHER]
            of_a = self.a.encode_batch_fast([" " + words[i] for i in some], add_special_tokens=False)
            of_b = self.b.encode([words[i] for i in some], num_threads=1)
            for i, a, b in zip(some, of_a, of_b):
                raw, a = (" " + words[i]).encode(), a.ids
                same = b"".join([self.a_bytes[t] for t in a]) == raw == b"".join([self.b_bytes[t] for t in b])
                out[i] = (struct.pack(f"<{len(a)}i", *a), struct.pack(f"<{len(b)}i", *b)) if same else (b"", b"")
        # Frequent words come early and stay.
        self.known.update((words[i], out[i]) for i in new[: max(KEPT_WORDS - len(self.known), 0)])
        return Words(out, self.a_sizes, self.b_sizes)

    def chunk(self, texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
        """The distinct words of the texts, aligned; the numbers of all texts' words in a row, and how many each text has. A
        text with a word whose bytes do not come back has none."""
        words, which, counts = self.words_of(texts)
        aligned = self.align(words)
        whole = sums(~aligned.good[which], counts) == 0
        if whole.all():
            return aligned, which, counts
        return aligned, which[np.repeat(whole, counts)], np.where(whole, counts, 0)


_ready: dict[tuple[str, bytes], Aligner] = {}


def _tokenizers(docs: DataFrame, definition: str, model: str):
    """What a task calls to have its aligner: the content of both files, of fixed size, goes to the tasks."""
    with open(definition, encoding="utf-8") as a, open(model, "rb") as b:
        content = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))

    def aligner() -> Aligner:
        if content.value not in _ready:
            _ready[content.value] = Aligner(*content.value)
        return _ready[content.value]

    return aligner


def align_documents(docs: DataFrame, definition: str, model: str) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the groups of its tokens.

    Columns: doc_id; groups, ``a1,a2|b1;a3|b2,b3`` with A's and B's ids of each group in decimal; ends, the byte behind each group, counted in a
    space and the whole text. Null and empty texts, and those whose bytes one of the tokenizers does not give back,
    have no groups. Rows that repeat stay. An empty table gives no rows. No rows are exchanged. ``definition`` and ``model`` are paths on
    the driver.
    """
    aligner = _tokenizers(docs, definition, model)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner()
        for chunk in gathered_chunks(batches, most=CHUNK_BYTES):
            words, which, counts = own.chunk(chunk.column("text"))
            texts, sizes = words.texts(), sums(own.a_sizes[words.a], words.n_a)
            from_start = np.cumsum(words.n_groups) - words.n_groups
            groups, ends = [], []
            for at, n in zip((np.cumsum(counts) - counts).tolist(), counts.tolist()):
                mine = which[at : at + n]
                groups.append("".join([texts[w] for w in mine.tolist()])[:-1])
                # Ends on the line of all words, moved to where the word lies in its text.
                move = np.cumsum(sizes[mine]) - np.cumsum(sizes)[mine]
                ends.append(words.group_ends[spread(from_start[mine], words.n_groups[mine])] + np.repeat(move, words.n_groups[mine]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": chunk.column("doc_id"), "groups": pa.array(groups, pa.string()), "ends": pa.array(ends, pa.list_(pa.int64())),
            })

    return docs.select("doc_id", "text").mapInArrow(align, "doc_id long, groups string, ends array<bigint>")


def _chunks(docs: DataFrame, definition: str, model: str) -> DataFrame:
    """One row for each chunk of documents: chunk; content, what is known of its documents and words, packed; keys (A's id in the
    upper 32 bits, B's below), the distinct id pairs that its links hold; counts, how many links hold each."""
    aligner = _tokenizers(docs, definition, model)

    def aligned(chunk: pa.RecordBatch, number: int) -> pa.RecordBatch:
        words, which, counts = aligner().chunk(chunk.column("text"))
        texts, digests = words.texts(), bytearray()
        for at, n in zip((np.cumsum(counts) - counts).tolist(), counts.tolist()):
            text = "".join([texts[w] for w in which[at : at + n].tolist()])[:-1]
            digests += hashlib.sha256(text.encode()).digest()
        times = np.bincount(which, minlength=len(texts))
        keys, pair = np.unique(words.a[words.link_a].astype(np.int64) << 32 | words.b[words.link_b], return_inverse=True)
        held = np.zeros(len(keys), np.int64)
        np.add.at(held, pair, np.repeat(times, words.n_links))
        doc_id = chunk.column("doc_id")
        content = pack(
            doc_id.fill_null(0).to_numpy(zero_copy_only=False), doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
            np.frombuffer(bytes(digests), np.uint8), narrow(counts), narrow(which), narrow(pair),
            *map(narrow, (words.n_a, words.n_b, words.n_groups, words.n_links)),
        )
        return pa.RecordBatch.from_pydict({
            "chunk": pa.array([number], pa.int64()), "content": pa.array([content], pa.binary()),
            "keys": pa.array([keys], pa.list_(pa.int64())), "counts": pa.array([held], pa.list_(pa.int64())),
        })

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in enumerate(gathered_chunks(batches, most=CHUNK_BYTES)):
            yield aligned(chunk, TaskContext.get().partitionId() << 32 | number)
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(align, "chunk long, content binary, keys array<bigint>, counts array<bigint>"), "chunks")


def _totals(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs of each chunk (chunk, at, key, n), and for each key of the corpus its count and whether that is the highest of
    its B id (ties included)."""
    pairs = chunks.select("chunk", F.posexplode(F.arrays_zip("keys", "counts")).alias("at", "pair")).select(
        "chunk", "at", F.col("pair.keys").alias("key"), F.col("pair.counts").alias("n"),
    )
    # One B id has no more pairs than A has ids.
    of_b = Window.partitionBy(F.col("key").bitwiseAND(F.lit((1 << 32) - 1)))
    totals = pairs.groupBy("key").agg(F.sum("n").alias("count")).where("count > 0").withColumn("best", F.col("count") == F.max("count").over(of_b))
    return pairs, totals


def linked_ids(docs: DataFrame, definition: str, model: str) -> DataFrame:
    """Every pair of ids that some link holds: a, b, count (links in all documents), best (whether no other A id is linked more often
    with that B id)."""
    _, totals = _totals(_chunks(docs, definition, model))
    return totals.select(
        F.shiftright("key", 32).cast("int").alias("a"), F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "count", "best",
    )


def alignment_digest(docs: DataFrame, definition: str, model: str) -> DataFrame:
    """For every row of ``docs`` (doc_id, text) its numbers of tokens, groups and links, those links whose id pair is the most
    frequent of its B id, the sum of the links' counts, and the SHA-256 of its groups' text.

    Texts without groups (see ``align_documents``) have zeros and an empty digest. Rows that repeat count each. An empty table gives
    no rows. The words of a chunk are encoded once; only the distinct pairs of a chunk travel, and their sums back to it.
    """
    chunks = _chunks(docs, definition, model)
    pairs, totals = _totals(chunks)
    answers = pairs.where("n > 0").join(totals, "key").select(F.col("chunk").alias("of"), "at", "count", "best")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        done = []
        for value in left["content"].to_pylist():
            doc_ids, no_id, digests, counts, which, pair, *numbers = unpack(value)
            at = right["at"].to_numpy()
            count, best = (np.zeros(int(pair.max()) + 1 if len(pair) else 0, np.int64) for _ in range(2))
            count[at], best[at] = right["count"].to_numpy(), right["best"].to_numpy().astype(np.int64)
            n_a, n_b, n_groups, n_links = (n.astype(np.int64) for n in numbers)
            of_words = n_a, n_b, n_groups, n_links, sums(best[pair], n_links), sums(count[pair], n_links)
            columns = [sums(of[which], counts.astype(np.int64)) for of in of_words]
            whole = digests.tobytes()
            shas = [whole[32 * i : 32 * i + 32].hex() if n else "" for i, n in enumerate(columns[0].tolist())]
            done.append(pa.table([pa.array(doc_ids, pa.int64(), mask=no_id.astype(bool)), *map(pa.array, columns), pa.array(shas, pa.string())], names))
        return pa.concat_tables(done)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    kind = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names)
    return chunks.select("chunk", "content").groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(answer, kind)
