"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from khodat.llm.common import stored
from khodat.llm.spelling import near_words, roots, spelling_variants


def one_edit(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    i = 0
    while i < min(len(x), len(y)) and x[i] == y[i]:
        i += 1
    return x[i + (len(x) >= len(y)) :] == y[i + (len(y) >= len(x)) :]


def brute(rows):
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            if r.doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def variants(seed, n=12):
    rng, texts = random.Random(seed), []
    bases = ["nation", "station", "Éclair", "façade", "relation", "abcde", "zzzzzz", "ststst", "naïveté"]
    for _ in range(n):
        words = []
        for _ in range(150):
            word = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at, kind = rng.randrange(len(word)), rng.randrange(3)
                word[at : at + (kind > 0)] = [] if kind == 1 else [rng.choice("abstéÉ")]
            words += ["".join(word)] * rng.choice([1, 1, 2, 9])
        texts.append(rng.choice([" ", ", ", "1", "\n"]).join(words))
    return texts


@pytest.mark.parametrize("together", [1, 5, 64])
def test_variants_of_all_pairs(documents, together):
    docs = documents(variants(together))
    wanted = brute(docs.collect())
    assert len(wanted) > 50 and any(w[2] not in (w[0], w[1]) for w in wanted)
    assert sorted(map(tuple, spelling_variants(docs, together).collect())) == wanted


def test_odd_texts(odd, documents):
    assert sorted(map(tuple, spelling_variants(odd).collect())) == brute(odd.collect())
    texts = ["x" * 30_000 + " " + "x" * 29_999, "A×Bcd÷e a×bcd÷e", "ßßßßß", "ÀÀÀÀÀ ààààà", None]
    docs = documents(texts * 4, ids=[1, 2, None, 4, 5] * 4)
    assert sorted(map(tuple, spelling_variants(docs).collect())) == brute(docs.collect())


def test_a_crowded_chunk_makes_no_pairs_of_all_words(spark):
    """Thousands of words share their ending: what is compared grows with them, not with their square."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("abcdefghij", k=5)) + "ation" for _ in range(3000)})
    frame = stored(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), "words")
    pairs = {frozenset((r.word, r.other)) for r in near_words(frame, 8).collect()}
    masks = {}
    for w in words:
        for i in range(len(w)):
            masks.setdefault((i, w[:i], w[i + 1 :]), []).append(w)
    assert pairs == {frozenset((x, y)) for own in masks.values() for x in own for y in own if x != y}
    assert near_words(frame, 8).count() == len(pairs)


def test_long_ways_to_a_root(spark):
    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(100)] + [("a", "b")], "word string, form string")
    assert {tuple(r) for r in roots(forms).collect()} == {(f"w{i:03}", "w100") for i in range(100)} | {("a", "b")}


def test_empty(documents):
    assert spelling_variants(documents([])).collect() == [] and spelling_variants(documents([None, "few words"])).collect() == []
