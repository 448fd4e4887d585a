"""Quality of documents by a convolutional network over their bytes, in numpy.

Filters run over the bytes of the whole document. Their largest responses are taken in chunks that overlap by half, and
the chunks are combined by their mean and their maximum into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khodat.llm.common import column, fresh

#: Labelled documents that the network learns from, at most: those with the smallest hash of doc_id.
SAMPLE_ROWS = 2000
FILTERS = 16
#: Bytes under a filter; even, since scoring looks bytes up in pairs.
WIDTH = 6
#: Bytes of half a chunk: a chunk is two halves, and the next one begins at the second.
HALF = 128
EPOCHS = 12
BATCH = 32
RATE = 0.01
SEED = 5
#: A document is of quality from this probability on.
THRESHOLD = 0.3


@dataclass
class ByteNetwork:
    """``tables[j][b]`` is what byte b at place j under the filters adds to each response."""

    tables: np.ndarray = field(default_factory=lambda: np.random.default_rng(SEED).normal(0, 0.2, (WIDTH, 256, FILTERS)).astype(np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(FILTERS, np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.random.default_rng(SEED + 1).normal(0, 0.2, 2 * FILTERS).astype(np.float32))
    offset: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))

    def __post_init__(self):
        self.pairs: list[np.ndarray] | None = None

    def halves(self, text: bytes) -> int:
        """Number of half chunks of a text; the last chunk may reach beyond its end."""
        return max(2, -(-len(text) // HALF))

    def padded(self, text: bytes) -> np.ndarray:
        """The bytes with zeros behind them, so that filters start at every place of every half."""
        out = np.zeros(self.halves(text) * HALF + WIDTH, np.uint8)
        out[: len(text)] = np.frombuffer(text, np.uint8)
        return out

    def responses(self, text: bytes) -> np.ndarray:
        """Filter responses at every byte. Bytes are looked up in pairs: the table of a pair is the sum of two tables."""
        if self.pairs is None:
            self.pairs = [(self.tables[j][None, :, :] + self.tables[j + 1][:, None, :]).reshape(65536, FILTERS) for j in range(0, WIDTH, 2)]
        data = self.padded(text).astype(np.uint16)
        pair = data[:-1] | (data[1:] << np.uint16(8))
        n = len(data) - WIDTH
        out = self.pairs[0].take(pair[:n], axis=0)
        for j, found in enumerate(self.pairs[1:], 1):
            out += found.take(pair[2 * j : 2 * j + n], axis=0)
        return out

    def chunks(self, text: bytes) -> np.ndarray:
        """The largest response of each filter in each chunk, after the bias, not below 0."""
        parts = []
        # Long texts go through in slices that overlap by one half chunk, so memory stays bounded.
        step = 512 * HALF
        for start in range(0, max(1, len(text) - HALF), step):
            own = self.responses(text[start : start + step + HALF + WIDTH] if len(text) > step else text)
            tops = own.reshape(-1, HALF, FILTERS).max(1)[: step // HALF + 1]
            parts.append(np.maximum(tops[:-1], tops[1:]))
        return np.maximum(np.concatenate(parts) + self.bias, 0)

    def score(self, text: bytes) -> float:
        found = self.chunks(text)
        return float(1 / (1 + np.exp(-(np.concatenate([found.mean(0), found.max(0)]) @ self.weights + self.offset[0]))))

    def gradients(self, text: bytes, label: float) -> tuple[np.ndarray, ...]:
        """Of the log loss, for each parameter; what does not reach a maximum has none."""
        data = self.padded(text)
        tops = self.responses(text).reshape(-1, HALF, FILTERS)
        places = tops.argmax(1)
        best = np.take_along_axis(tops, places[:, None], 1)[:, 0]
        places += np.arange(len(best))[:, None] * HALF
        later = best[1:] > best[:-1]
        value = np.maximum(np.where(later, best[1:], best[:-1]) + self.bias, 0)
        place = np.where(later, places[1:], places[:-1])
        pooled = np.concatenate([value.mean(0), value.max(0)])
        wrong = 1 / (1 + np.exp(-(pooled @ self.weights + self.offset[0]))) - label
        back = np.repeat(wrong * self.weights[None, :FILTERS] / len(value), len(value), 0)
        back[value.argmax(0), np.arange(FILTERS)] += wrong * self.weights[FILTERS:]
        back[value <= 0] = 0
        tables = np.zeros_like(self.tables)
        filters = np.broadcast_to(np.arange(FILTERS), place.shape)
        for j in range(WIDTH):
            np.add.at(tables[j], (data[place + j], filters), back)
        return tables, back.sum(0).astype(np.float32), (wrong * pooled).astype(np.float32), np.array([wrong], np.float32)

    def fit(self, texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> ByteNetwork:
        """Adam over small batches in a seeded order. Without texts the network stays as it is: it knows nothing."""
        rng = np.random.default_rng(SEED)
        parameters = [self.tables, self.bias, self.weights, self.offset]
        first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for batch in np.array_split(order, -(-len(texts) // BATCH)) if len(texts) else []:
                step += 1
                sums = [sum(g) / len(batch) for g in zip(*(self.gradients(texts[i], labels[i]) for i in batch))]
                for p, g, m, v in zip(parameters, sums, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                self.pairs = None
        return self


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept from learning; a null doc_id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ByteNetwork:
    """The network fitted to ``labels`` (doc_id, quality) of ``docs`` (doc_id, text) that are not held out.

    It learns from at most ``sample_rows`` whole texts, those whose doc_id has the smallest hash; that many rows come to
    the driver. Null labels, and labels that contradict each other, teach nothing; a repeated label counts once.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample_rows)
        .select("text", "quality").collect()
    )
    return ByteNetwork().fit([(r.text or "").encode() for r in rows], [r.quality for r in rows])


def score_documents(docs: DataFrame, network: ByteNetwork, name: str = "score") -> DataFrame:
    """``docs`` with the probability of quality of each whole text as column ``name``. Null scores as the empty text, which has a score
    too. Rows stay in place: nothing is exchanged between tasks."""
    state = (network.tables, network.bias, network.weights, network.offset)

    @F.pandas_udf("double")
    def probability(texts):
        own = ByteNetwork(*state)
        return pd.Series([own.score(t.encode() if t else b"") for t in texts], dtype="float64")

    return docs.withColumn(name, probability("text"))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its score and the decision. An empty table gives no rows."""
    scored = score_documents(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the network does not reject, with all their columns."""
    name = fresh(docs, "score")
    return score_documents(docs, learn(docs, labels), name).where(F.col(name) >= THRESHOLD).select(*[column(c) for c in docs.columns])
