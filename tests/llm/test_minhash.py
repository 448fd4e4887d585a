"""Near duplicates against all pairs, and the parts of the sketch."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from khodat.llm.components import components
from khodat.llm.minhash import (
    BANDS, alone, apart, band_keys, chance, crowded_links, drop_near_duplicates, estimates, in_groups, met, near_digest, near_duplicates, registers,
    shingle_sets,
)


def brute_sets(texts):
    sets = []
    for t in texts:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets.append({tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set())
    return sets


def brute_components(rows):
    sets, root = brute_sets([r.text for r in rows]), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    names = {}
    for i, r in enumerate(rows):
        names.setdefault(find(i), []).append(r.doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in names.items()}
    return sorted(((r.doc_id, len(sets[i]), least[find(i)], r.doc_id is not None and r.doc_id == least[find(i)]) for i, r in enumerate(rows)), key=str)


def varied(seed, n_bases=6, words=60):
    rng, texts = random.Random(seed), []
    for b in range(n_bases):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        texts.append(" ".join(base))
        for edits in (0, 1, 1, 2, 3, 4, 6):
            own = list(base)
            for _ in range(edits):
                own[rng.randrange(words)] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(own) + (" tail of it" if edits == 2 else ""))
    return texts


@pytest.mark.parametrize("words", [4, 9, 60, 400])
def test_components_are_those_of_all_pairs(documents, words):
    docs = documents(varied(words, words=words))
    assert sorted(map(tuple, near_digest(docs).collect()), key=str) == brute_components(docs.collect())


def test_odd_texts(odd):
    assert sorted(map(tuple, near_digest(odd).collect()), key=str) == brute_components(odd.collect())
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({r.group for r in near_duplicates(odd).collect()})


def test_empty(documents):
    assert near_digest(documents([])).collect() == [] and drop_near_duplicates(documents([])).collect() == []
    assert [r.n_shingles for r in near_digest(documents([None, " "])).collect()] == [0, 0]


def test_visits_and_meetings(spark, monkeypatch):
    """A chain a - b - c where a and c are not linked, in one bucket, in blocks of one, two and many members."""
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words), " ".join(words[8:] + [f"x{i}" for i in range(2)]), " ".join(words[20:] + [f"x{i}" for i in range(4)]), "far away from all others here"]
    sets = shingle_sets(pa.array(texts))
    classes = spark.createDataFrame(
        [(i, bytearray(v.tobytes()), len(s)) for i, (v, s) in enumerate(zip(registers(sets), sets))], "class long, registers binary, n_shingles long"
    )
    full = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)], "row long, shingles array<bigint>")
    buckets = spark.createDataFrame([(5, i) for i in range(4)], "key long, class long")
    groups = lambda *rows: in_groups(classes, spark.createDataFrame(list(rows), "a long, b long") if rows else None)
    for block in (1, 2, 1024):
        monkeypatch.setattr("khodat.llm.minhash.BLOCK", block)
        monkeypatch.setattr("khodat.llm.minhash.MEETING", block)
        alone = {(r.a, r.together, r.b) for r in apart(buckets, groups(), classes).collect()}
        assert {(0, 1, 1), (1, 2, 2)} <= alone and not any(3 in v for v in alone)
        pair = groups((2, 1))
        visits = apart(buckets, pair, classes)
        assert [(r.a, r.together, r.b) for r in visits.collect()] == [(0, 1, 1)]
        assert {tuple(r) for r in met(visits.select("a", "together"), pair, full).collect()} == {(0, 1)}
        wrong = spark.createDataFrame([(3, 1), (0, 1)], "a long, together long")
        assert {tuple(r) for r in met(wrong, pair, full).collect()} == {(0, 1)}
    both = in_groups(classes, spark.createDataFrame([(2, 3)], "a long, b long"), groups((0, 1)))
    assert sorted(map(tuple, in_groups(classes, spark.createDataFrame([(3, 0)], "a long, b long"), both).select("class", "together", "many").collect())) == [
        (c, 0, 4) for c in range(4)
    ]
    assert apart(buckets, groups((1, 0), (2, 1), (3, 0)), classes).collect() == []


def test_a_large_group_whose_members_are_not_all_linked(documents):
    """Copies of one text with many edits: most are linked with some other copy, few with the first, some with none."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(150):
        own = list(base)
        for _ in range(rng.randrange(1, 5)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    docs = documents(texts)
    wanted = brute_components(docs.collect())
    assert 5 < len({w[2] for w in wanted}) < 140
    assert sorted(map(tuple, near_digest(docs).collect()), key=str) == wanted


def test_registers_hold_the_zeros_and_what_follows():
    hashes = np.array([0, 1, 5 << 57 | 1 << 56, 6 << 57 | 3 << 40, 6 << 57 | 1 << 50], np.uint64)
    own = registers([np.unique(hashes), np.zeros(0, np.uint64)])
    assert own[0][0] == 58 << 10 and own[0][5] == 1 << 10 and own[0][6] == (16 << 10 | 1 << 9) and own[0].astype(bool).sum() == 3
    assert not own[1].any()


def test_estimates_are_corrected_for_chance():
    rng = np.random.default_rng(1)
    for shared, own in ((0, 1000), (900, 100), (500, 500), (80, 20)):
        hits = []
        for _ in range(40):
            common = rng.integers(0, 2**64, shared, np.uint64)
            a, b = (np.unique(np.r_[common, rng.integers(0, 2**64, own, np.uint64)]) for _ in range(2))
            ra, rb = registers([a, b])
            by_chance = chance(len(a), len(b))
            hits.append((((ra == rb) & (ra > 0)).sum() / ((ra > 0) | (rb > 0)).sum() - by_chance) / (1 - by_chance))
            if shared / (shared + 2 * own) >= 0.8:
                assert estimates(ra[None], rb[None], np.array([len(a)]), np.array([len(b)]))[1].all()
        assert abs(np.mean(hits) - shared / (shared + 2 * own)) < 0.03


def test_no_linked_pair_is_ruled_out():
    rng = np.random.default_rng(12)
    for n in (5, 9, 18, 45, 90, 150, 300, 900, 5000):
        for _ in range(300 if n < 1000 else 40):
            shared = -(-8 * n // 9)  # just linked: 8 of 10 in the union
            a = rng.integers(0, 2**64, n, np.uint64)
            b = np.r_[a[:shared], rng.integers(0, 2**64, n - shared, np.uint64)]
            sets = [np.unique(a), np.unique(b)]
            both = len(np.intersect1d(*sets))
            assert 100 * both >= 80 * (len(sets[0]) + len(sets[1]) - both)
            left, right = registers(sets)
            assert estimates(left[None], right[None], np.array([len(sets[0])]), np.array([len(sets[1])]))[1].all(), n


def test_similar_small_sets_share_bands():
    rng = np.random.default_rng(2)
    missed = 0
    for n in (5, 10, 20, 100):
        for _ in range(100):
            a = rng.integers(0, 2**64, n, np.uint64)
            b = a[: n - n // 9] if n >= 9 else a[:-1]
            keys = band_keys(registers([np.unique(a), np.unique(b)]))
            assert keys.shape == (2, BANDS)
            missed += not (keys[0] == keys[1]).any()
    assert missed == 0


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=40))
@settings(max_examples=6, deadline=None)
def test_components_of_any_graph(spark, links):
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.component for r in rows} == root and len(rows) == len(root)


def test_components_of_a_chain_a_star_and_nulls(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 700)]
    rows = components(spark.createDataFrame([*chain, *star, (None, 3), (7, None), (9, 9)], "a long, b long")).collect()
    assert {r.id: r.component for r in rows} == {9: 9} | {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 700)}


@pytest.mark.parametrize("words", [9, 60])
def test_crowded_buckets_give_the_same_groups(documents, monkeypatch, words):
    """Every bucket counts as crowded, and blocks hold three classes."""
    monkeypatch.setattr("khodat.llm.minhash.CROWD", 1)
    monkeypatch.setattr("khodat.llm.minhash.MEETING", 3)
    monkeypatch.setattr("khodat.llm.minhash.LEADERS", 0)
    docs = documents(varied(words, words=words) + ["a b c d e f g h", "a b c d e f g h i"])
    assert sorted(map(tuple, near_digest(docs).collect()), key=str) == brute_components(docs.collect())


def crowd(spark, sets):
    """All sets in one bucket, none linked yet."""
    classes = spark.createDataFrame(
        [(i, bytearray(v.tobytes()), len(s)) for i, (v, s) in enumerate(zip(registers(sets), sets))], "class long, registers binary, n_shingles long"
    )
    full = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)], "row long, shingles array<bigint>")
    buckets = spark.createDataFrame([(5, i) for i in range(len(sets))], "key long, class long")
    return buckets, classes, full


@pytest.mark.parametrize("shared_ends", [False, True])
def test_a_template_makes_few_rows(spark, shared_ends):
    """Documents of one template at a likeness of 0.73, none linked: no rows, however many there are. The ends are their own, or each
    is shared with some others."""
    rng = np.random.default_rng(4)
    template, ends = rng.integers(0, 2**63, 270, np.uint64), rng.integers(0, 2**63, (40, 25), np.uint64)
    sets = [np.unique(np.concatenate([template, *(ends[[i % 40, (i * 7 + i // 40) % 40]] if shared_ends else [rng.integers(0, 2**63, 50, np.uint64)])])) for i in range(800)]
    sets = [s if len(s) == 320 else np.unique(np.concatenate([s, rng.integers(0, 2**63, 320 - len(s), np.uint64)])) for s in sets]
    buckets, classes, full = crowd(spark, sets)
    found = crowded_links(buckets, in_groups(classes), classes, full).collect()
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))] if shared_ends else []
    # No more rows than classes in each of the 4 x 4 pairs of blocks, and all groups that all pairs would give.
    assert len(found) <= 16 * len(sets) and bool(found) == bool(linked)
    if linked:
        name = {r.id: r.component for r in components(spark.createDataFrame(linked, "a long, b long")).collect()}
        assert name == {r.id: r.component for r in components(spark.createDataFrame(found, "a long, b long")).collect()}


def test_classes_with_too_many_shingles_of_their_own_are_left_out(spark):
    together = np.arange(100, dtype=np.uint64) * np.uint64(2**57)
    sets = [together[:80], together[:81], np.unique(np.append(together[:79], np.arange(1, 21, dtype=np.uint64))), np.unique(np.append(together[:78], np.arange(30, 52, dtype=np.uint64)))]
    buckets, classes, full = crowd(spark, sets)
    assert {r["class"] for r in alone(classes.select("class", "n_shingles"), full).collect()} == {2, 3}
    assert {tuple(r) for r in crowded_links(buckets, in_groups(classes), classes, full).collect()} == {(0, 1)}
