"""Wavelet matrices against plain arrays, and shards against the tokenizer run on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from khodat.llm.wavelet import Shard, WordEncoder, documents_in, occurrences_in, read_file, token_count, token_digest, write_shards

DEFINITION = public_tokenizers.path("word_bpe_49k.json")


def shard(documents):
    flat = np.array([i for d in documents for i in d], np.uint32)
    n = len(documents)
    return Shard(Shard.content(np.arange(n), np.zeros(n, bool), np.array([len(d) for d in documents], np.int64), flat)), flat


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 70_000)), max_size=700), min_size=1, max_size=8), st.data())
def test_every_question_has_the_answer_of_the_plain_array(documents, data):
    own, flat = shard(documents)
    assert len(own) == len(flat) and own.all_ids().tolist() == flat.tolist()
    assert own.access(np.arange(len(flat))).tolist() == flat.tolist()
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(flat)), st.integers(0, len(flat)))))
    for token in {*flat[:3].tolist(), 0, 3, 69_999, 1 << 20}:
        places = a + np.flatnonzero(flat[a:b] == token)
        assert own.count(token, a, b) == len(places)
        assert own.occurrences(token, a, b).tolist() == places.tolist()
    starts = np.cumsum([0] + [len(d) for d in documents])
    assert own.starts.tolist() == starts.tolist()
    if len(flat):
        assert own.document_of(np.arange(len(flat))).tolist() == [i for i, d in enumerate(documents) for _ in d]


def test_a_few_planes_of_a_large_shard():
    rng = np.random.default_rng(1)
    flat = rng.zipf(1.3, 300_000).clip(0, 49_000)
    own, _ = shard([flat])
    assert own.all_ids().tolist() == flat.tolist()
    assert [own.count(i) for i in range(1, 50)] == [(flat == i).sum() for i in range(1, 50)]
    assert own.occurrences(7).tolist() == np.flatnonzero(flat == 7).tolist()
    with pytest.raises(ValueError):
        Shard(b"something else")


def brute(rows):
    tokenizer = Tokenizer.from_file(DEFINITION)
    tokenizer.no_truncation(), tokenizer.no_padding()
    out, start = [], 0
    for r in sorted(enumerate(rows), key=lambda x: (x[1].doc_id is not None, x[1].doc_id or 0, x[0])):
        ids = [*tokenizer.encode(r[1].text or "", add_special_tokens=False).ids, 2]
        out.append((r[1].doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def in_order(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("most", [1, 50, 1 << 22])
def test_shards_give_back_what_the_tokenizer_makes_of_whole_texts(odd, spark, most):
    wanted = brute(odd.collect())
    shards = write_shards(odd, DEFINITION, 2, most=most)
    assert in_order(documents_in(shards)) == [w[:4] for w in wanted]
    assert [np.frombuffer(r[4], "<u4").tolist() for r in in_order(documents_in(shards, ids=True))] == [w[4] for w in wanted]
    files = shards.collect()
    assert sum(f.n_ids for f in files) == sum(w[2] for w in wanted) and sum(f.n_docs for f in files) == len(wanted)
    if most == 1:
        assert len(files) > 1
    for token in (2, wanted[3][4][0], 49_407):
        holding = [(w[0], w[1], w[4].count(token), w[4].index(token)) for w in wanted if token in w[4]]
        assert in_order(occurrences_in(shards, token)) == holding
        assert token_count(shards, token) == sum(h[2] for h in holding)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert in_order(token_digest(docs, DEFINITION)) == [w[:4] for w in brute(docs.collect())]


def test_special_strings_and_odd_spaces(documents):
    docs = documents(["a<|endoftext|>b <|startoftext|>", "x\x85y z　q", "don't  can't'LL", "é É", "Ω K", "١٢ 12ab"], ids=[5, 4, 3, 3, 7, -1, 0])
    assert in_order(token_digest(docs, DEFINITION)) == [w[:4] for w in brute(docs.collect())]


def test_files_can_be_read_alone(documents, tmp_path):
    folder = f"file://{tmp_path}/shards"
    shards = write_shards(documents(["one two", None, "two"], ids=[2, 1, 3]), DEFINITION, 9, folder=folder).collect()
    assert all(r.uri.startswith(folder) for r in shards)
    own = read_file(shards[0].uri)
    assert own.doc_ids.tolist() == [1, 2, 3] and own.all_ids()[0] == 9 and own.count(9) == 3


def test_empty(documents):
    assert token_digest(documents([]), DEFINITION).collect() == []
    shards = write_shards(documents([]), DEFINITION, 2)
    assert shards.collect() == [] and token_count(shards, 2) == 0 and occurrences_in(shards, 2).collect() == []


def test_words_are_encoded_once_whatever_signs_follow(monkeypatch):
    """Words of Latin letters go to the model without the signs and digits behind them, and kept words need no tokenizer."""
    texts = [f"{w}{end}" for w in ("haus", "Größe", "été", "ÀÖØöøÿ", "µm", "x÷y") for end in ("", "$$$", "'", "''1", "%,%", "12", "=]", "_", "<|", "|>", "´", "~́")]
    texts += ["don't dogs' l'été' it's'", "a<|endoftext|> b<|endoftext|>$ $<|startoftext|>", "ＡＢ, Ωmega; 日本! 12%a ²$ é$"]
    tokenizer, encoder = Tokenizer.from_file(DEFINITION), WordEncoder(open(DEFINITION, encoding="utf-8").read())
    wanted = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    for kept in (0, 7, 1 << 20):
        monkeypatch.setattr("khodat.llm.wavelet.KEPT_WORDS", kept)
        for _ in range(2):
            ids, lengths = encoder.encode_texts(pa.array(texts), 2)
            assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == wanted
    given, encoded = [], encoder.encoded
    monkeypatch.setattr(encoder, "encoded", lambda words: given.extend(words) or encoded(words))
    encoder.encode_texts(pa.array(["haus$$ Größe=1", "haus%, été[]"]), 2)
    # The ASCII of texts is lower-cased before, other letters are not.
    assert not [w for w in given if any(c.isalpha() for c in w)]
