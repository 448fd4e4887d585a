"""Encoding and decoding against the tokenizers library."""

import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from khodat.llm.bpe import Bpe, encode_digest, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as file:
    OURS = Bpe(file.read())

ODD = [
    "", " ", "ΑΣ ΟΔΟΣ Σ", "<|endoftext|>x<|startoftext|>", "I'LL don't 're' 1'sA'S'T", "é ÅÅ　x\x1cy\x85z​q", "日本語 ¼½ ①23", "İI ſ ß ẞ",
    "à́ ̀b", "😀👨‍👩‍👧 x", "</w> Ġ Ā", "\x00\x01", " \n\t lead", "<|endoftext|", "ǅ Dž K", "﻿bom", "᾿Αᾳ ΑΙ ᾼ", "x y z", "aaaa" * 3000, "the " * 5000,
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OURS.encode(text) == ids and OURS.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@given(st.text(st.characters(max_codepoint=0x24FF, exclude_categories=["Cs", "Cn"]), max_size=30))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OURS.encode(text) == ids and OURS.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_documents(odd, documents):
    rows = {r.doc_id: r for r in encode_digest(odd, PATH).collect()}
    assert encode_digest(odd, PATH).count() == odd.count()
    for doc in odd.collect():
        ids = LIBRARY.encode(doc.text or "", add_special_tokens=False).ids
        assert rows[doc.doc_id].n_tokens == len(ids)
        assert rows[doc.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert rows[doc.doc_id].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert encode_documents(documents([]), PATH).collect() == []


def test_a_full_store_changes_nothing(monkeypatch):
    monkeypatch.setattr("khodat.llm.bpe.KEPT_WORDS", 3)
    text = " ".join(ODD)
    assert OURS.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids
