"""Byte-pair encoding and decoding of whole texts with the definition file of a public tokenizer.

A word's symbols form a doubly linked list. A priority queue holds the merges that neighbours allow, by rank and then
by place; a merge that no longer fits its place is skipped when it comes up.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khodat.llm.common import text_chunks, whole_texts

#: Words whose ids a worker keeps at a time; a full store is emptied. It saves work and changes no result.
KEPT_WORDS = 150_000

# What the definition's pattern calls white space: the Unicode property (fixed values).
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others in order from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Bpe:
    """The tokenizer that a definition describes: NFC, white space, lower case, a splitting pattern, byte letters, merges
    up to a word end. ``definition`` is the JSON text of its file."""

    def __init__(self, definition: str):
        parts = json.loads(definition)
        model = parts["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        steps = [n["type"] for n in parts["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or parts["decoder"] or parts["post_processor"]:
            raise ValueError(f"not a definition of this kind: {steps}")
        pattern = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace("\\s", SPACE)
        self.pieces = regex.compile(pattern, regex.V0).findall
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        ids = self.vocabulary
        size = max([*ids.values(), *self.special.values()]) + 1
        # For each id the ranks of its merges by the id that follows, and the id that each rank makes. The last is for -1.
        self.ranks: list[dict[int, int]] = [{} for _ in range(size + 1)]
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[left]][ids[right]] = rank
            self.made.append(ids[left + right])
        letters = byte_letters()
        self.inner = [ids.get(c) for c in letters]
        self.last = [ids.get(c + self.suffix) for c in letters]
        self.strings = [b""] * size
        for text, i in [*ids.items(), *self.special.items()]:
            self.strings[i] = text.encode()
        self.known: dict[str, bytes] = {}
        self.known_pieces: dict[str, list[int]] = {}

    def piece(self, text: str) -> list[int]:
        """Ids of one piece of the pattern: merges in the order of the queue until none is left."""
        raw = text.encode()
        ids = [i for i in [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]] if i is not None]
        ranks, made, end = self.ranks, self.made, len(ids)
        # Entries are rank and place in one number. Merged symbols and the one behind the last are -1, which no merge has.
        queue = [rank << 32 | at for at, (a, b) in enumerate(zip(ids, ids[1:])) if (rank := ranks[a].get(b)) is not None]
        heapify(queue)
        after, before = list(range(1, end + 1)), list(range(-1, end))
        ids.append(-1)
        while queue:
            entry = heappop(queue)
            at = entry & 0xFFFFFFFF
            right = after[at]
            now = ranks[ids[at]].get(ids[right])
            # Stale: this symbol was merged away, or its pair is another one by now.
            if now is None or (new := made[entry >> 32]) != made[now]:
                continue
            ids[at], ids[right] = new, -1
            after[at] = beyond = after[right]
            after[right] = end
            before[beyond] = at
            if (rank := ranks[new].get(ids[beyond])) is not None:
                heappush(queue, rank << 32 | at)
            if (left := before[at]) >= 0 and (rank := ranks[ids[left]].get(new)) is not None:
                heappush(queue, rank << 32 | left)
        return [i for i in ids if i >= 0]

    def word(self, text: str) -> bytes:
        """Ids of a word, four bytes each, without ASCII white space; no piece, no special token and no composed letter reaches across that."""
        if (ids := self.known.get(text)) is not None:
            return ids
        out: list[int] = []
        for i, part in enumerate(self.specials.split(text) if "<" in text else (text,)):
            if i % 2:
                out.append(self.special[part])
                continue
            # Lower case letter by letter: a final sigma is no exception.
            part = part.lower() if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            # Letters alone are one piece.
            for piece in (part,) if part.isalpha() else self.pieces(part):
                if (own := self.known_pieces.get(piece)) is None:
                    if len(self.known_pieces) >= KEPT_WORDS:
                        self.known_pieces.clear()
                    own = self.known_pieces[piece] = self.piece(piece)
                out += own
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        ids = self.known[text] = pack(f"<{len(out)}I", *out)
        return ids

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.word(w.decode()) for w in text.encode().split()), "<u4").tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The vocabulary's strings, one space between them: a definition without a decoder joins them so."""
        return b" ".join([self.strings[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode()

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids start (one more than there are texts). Null is empty."""
        lists = pc.ascii_split_whitespace(whole_texts(texts))
        starts = np.asarray(lists.offsets, np.int64)
        coded = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        words = [self.word(w) for w in coded.dictionary.to_pylist()]
        lengths = np.array([len(w) for w in words], np.int64) // 4
        ids, at = np.frombuffer(b"".join(words), "<u4"), np.cumsum(lengths) - lengths
        which = coded.indices.to_numpy(zero_copy_only=False)
        own = lengths[which]
        ends = np.concatenate([[0], np.cumsum(own)])
        places = np.repeat(at[which] - ends[:-1], own) + np.arange(ends[-1])
        return ids[places], ends[starts - starts[0]]


_ready: dict[str, Bpe] = {}


def encode_documents(docs: DataFrame, definition: str) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the ids of its whole text and the text that they decode to.

    ``definition`` is the path of the definition file on the driver; its content, of fixed size, goes to the tasks.
    Columns: doc_id, ids (unsigned 32-bit little-endian integers in a row), decoded. Null counts as the empty text,
    which has no ids and decodes to the empty text. Repeated rows stay. An empty table gives no rows. No rows are
    exchanged between tasks. A worker keeps the ids of words it has seen, a bounded number of them.
    """
    with open(definition, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if content.value not in _ready:
            _ready[content.value] = Bpe(content.value)
        bpe = _ready[content.value]
        for chunk in text_chunks(batches, most=4 << 20):
            ids, starts = bpe.encode_texts(chunk.column("text"))
            bounds = list(zip(starts[:-1].tolist(), starts[1:].tolist()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": chunk.column("doc_id"),
                "ids": pa.array([ids[a:b].tobytes() for a, b in bounds], pa.binary()),
                "decoded": pa.array([bpe.decode_bytes(ids[a:b].tolist()).decode() for a, b in bounds], pa.string()),
            })

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids binary, decoded string")


def encode_digest(docs: DataFrame, definition: str) -> DataFrame:
    """Number of ids, and SHA-256 of the ids and of the decoded text, for every row of ``docs``."""
    return encode_documents(docs, definition).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
