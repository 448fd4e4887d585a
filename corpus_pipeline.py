"""From documents to token ids: the stages of a training corpus, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khodat.llm.bpe import encode_documents
from khodat.llm.common import stored, table
from khodat.llm.exact import drop_exact_duplicates
from khodat.llm.minhash import drop_near_duplicates
from khodat.llm.mixing import mix
from khodat.llm.quality import keep_quality
from khodat.llm.queries import ORACLES, QUERIES, TOKENIZER

#: The classifier and the seeded choice of the mix have no counterpart in SQL.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shingles of five words; four are what the query op5 alone is asked for."""
    return drop_near_duplicates(docs, words=5)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, as often as the mix holds it, and the checksum of what they decode to."""
    return encode_documents(docs, public_tokenizers.path(TOKENIZER)).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("MinHash near-dedup", dissimilar_documents),
    ("mixing sources to target weights", mixed_documents),
    ("BPE encoding and decoding", encoded_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = run
if ORACLE_SQL is not None:
    ORACLES["pipeline"] = ORACLE_SQL
