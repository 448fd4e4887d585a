"""Small tables with everything odd in them, stored as the operators expect."""

import pytest

from khodat.llm.common import stored

ODD_TEXTS = [
    None, "", " \t\n", "a", "A", "a b", "a  b\n", "x" * 50_000, "word " * 30_000, "é ß 日本 😀", "é", "\x00 \x85",
    "the same text of eight words stands here", "the same text of eight words stands here", "The same text of eight WORDS stands here",
]


@pytest.fixture
def documents(spark):
    """A function from texts (or rows with doc_id, text, source) to a stored table with columns that clash with inner names."""

    def make(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        rows = [(i, t, "en", s, 1, "x", 7, "y", "z") for i, t, s in zip(ids, texts, sources)]
        kind = "doc_id long, text string, lang string, source string, n_chars long, row string, size int, score string, `a.b` string"
        return stored(spark.createDataFrame(rows, kind).coalesce(3), "documents")

    return make


@pytest.fixture
def odd(documents):
    n = len(ODD_TEXTS)
    return documents([*ODD_TEXTS, "doubled row", "doubled row"], ids=[*range(n - 1), None, 99, 99])
