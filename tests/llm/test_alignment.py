"""Aligned tokens against a plain search over all intervals, on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from khodat.llm.alignment import Aligner, align_documents, alignment_digest, coalesced, linked_ids, overlaps
from khodat.llm.bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "two  spaces and   three", " begins with one", "ends with one ", "a\nb \n c\t d", "x▁y is lost", "naïve 日本語 \U0001f600 \U0001f468‍\U0001f469", "<|endoftext|> <s> </s> <unk> <0x0A>",
    "it's don't we'LL 's", " a  b", "a   b　c", "\x1c a\x1db \x85 c", "é ﬁ Å", "12345 67 890,12", "  ", " ", "''s ' s", "﻿bom ​ zero",
]


def plain(texts):
    """Tokens of whole texts, groups by cutting where both end, links by testing all pairs."""
    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    a_of = lambda i: bytes(byte_of[c] for c in a_tok.id_to_token(i))
    b_of = lambda i: bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()
    out, counts = [], Counter()
    for text in texts:
        raw = (" " + text).encode() if text else b""
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        if b"".join(map(a_of, a)) != raw or b"".join(map(b_of, b)) != raw:
            a, b = [], []
        spans = []
        for ids, of in ((a, a_of), (b, b_of)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(of(i)), i))
                at += len(of(i))
            spans.append(own)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for s, e, i in own if low <= s and e <= high) for own in spans))
        links, first = [], 0
        for s, e, i in spans[0]:
            while first < len(spans[1]) and spans[1][first][1] <= s:
                first += 1
            links += [(i, j) for t, f, j in spans[1][first : first + 200] if t < e and s < f]
        counts.update(links)
        out.append((len(a), len(b), cuts, links, ";".join(groups)))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    rows = [
        (n_a, n_b, len(cuts), len(links), sum(counts[k] == top[k[1]] for k in links), sum(counts[k] for k in links),
         hashlib.sha256(g.encode()).hexdigest() if n_a else "")
        for n_a, n_b, cuts, links, g in out
    ]
    return rows, [(g, cuts) for _, _, cuts, _, g in out], {k: (n, n == top[k[1]]) for k, n in counts.items()}


def check(docs):
    rows = docs.collect()
    wanted, groups, counts = plain([r.text for r in rows])
    assert sorted(map(tuple, alignment_digest(docs, A, B).collect()), key=str) == sorted(((r.doc_id, *w) for r, w in zip(rows, wanted)), key=str)
    found = [(r.doc_id, r.groups, r.ends) for r in align_documents(docs, A, B).collect()]
    assert sorted(found, key=str) == sorted(((r.doc_id, *g) for r, g in zip(rows, groups)), key=str)
    assert {(r.a, r.b): (r["count"], r.best) for r in linked_ids(docs, A, B).collect()} == counts


def test_odd_texts(odd):
    check(odd)


@pytest.mark.parametrize("chunk", [1, 60, 8 << 20])
def test_spaces_signs_and_other_scripts(documents, monkeypatch, chunk):
    monkeypatch.setattr("khodat.llm.alignment.CHUNK_BYTES", chunk)
    check(documents(ODD + ODD[:3] + ["the same words the same words the"] * 3))


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    wanted, _, _ = plain([r.text for r in rows])
    assert sorted(map(tuple, alignment_digest(docs, A, B).collect()), key=str) == sorted(((r.doc_id, *w) for r, w in zip(rows, wanted)), key=str)


def test_words_alone_have_the_tokens_that_they_have_in_a_text():
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        aligner = Aligner(a.read(), b.read())
    rng = random.Random(3)
    signs = [" ", " ", " ", "  ", "\n", "\t", "'", "s", "'s", "a", "ab", "word", ",", ".", "1", "23", "é", "日", " ", " ", "\U0001f600", "<s>", "-"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(1, 25))) for _ in range(3000)]
    for text in texts:
        words = aligner.split(text)
        assert " ".join(words) == text
        distinct, which, counts = aligner.words_of(pa.array(["x", text]))
        assert [distinct[i] for i in which] == ["x", *words] and counts.tolist() == [1, len(words)]
        own = aligner.align(words)
        assert own.a.tolist() == aligner.a.encode(" " + text, add_special_tokens=False).ids
        assert own.b.tolist() == aligner.b.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.randoms())
def test_groups_and_overlaps_of_intervals(sizes, rng):
    a = np.array(sizes)
    total, b = int(a.sum()), []
    while sum(b) < total:
        b.append(min(rng.randint(1, 6), total - sum(b)))
    a_ends, b_ends = np.cumsum(a), np.cumsum(b)
    a_starts, b_starts = a_ends - a, b_ends - np.array(b)
    side = np.repeat([0, 1], [len(a), len(b)])
    order, group = coalesced(np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends]), side)
    assert group[-1] + 1 == len({*a_ends.tolist()} & {*b_ends.tolist()})
    pairs = {(i, j) for i in range(len(a)) for j in range(len(b)) if a_starts[i] < b_ends[j] and b_starts[j] < a_ends[i]}
    found = list(zip(*(x.tolist() for x in overlaps(a_starts, a_ends, b_starts, b_ends))))
    assert len(found) == len(set(found)) and set(found) == pairs


def test_empty(documents):
    assert alignment_digest(documents([]), A, B).collect() == [] and align_documents(documents([]), A, B).collect() == []
    assert linked_ids(documents([None, ""]), A, B).collect() == []
    assert [tuple(r) for r in alignment_digest(documents([None, ""]), A, B).orderBy("doc_id").collect()] == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]
