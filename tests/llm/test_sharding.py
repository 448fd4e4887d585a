"""Differencing and the shards it gives."""

import itertools
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from khodat.llm.sharding import difference, shard_documents


def spread(sizes, shards_of, shards):
    sums = [0] * shards
    for s, at in zip(sizes, shards_of):
        sums[at] += s
    return max(sums) - min(sums)


@given(st.lists(st.integers(1, 50), min_size=1, max_size=8), st.integers(1, 3))
@settings(max_examples=80, deadline=None)
def test_difference_deals_each_size_once_and_near_the_best(sizes, shards):
    dealt = difference(sizes, shards)
    assert len(dealt) == len(sizes) and set(dealt) <= set(range(shards))
    best = min(spread(sizes, p, shards) for p in itertools.product(range(shards), repeat=len(sizes))) if shards ** len(sizes) < 7000 else 0
    assert spread(sizes, dealt, shards) <= max(sizes) and spread(sizes, dealt, shards) >= best


def test_difference_of_many_sizes_is_tight():
    sizes = [1 + (i * 7919) % 1000 for i in range(3000)]
    assert spread(sizes, difference(sizes, 8), 8) <= 2
    assert difference([], 8) == []


def check(rows, docs, shards):
    assert len(rows) == len(docs)
    slots, places = defaultdict(list), defaultdict(set)
    wanted = sorted((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs if r.doc_id is not None)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == wanted
    for r in rows:
        slots[r.shard].append(r.slot)
        places[r.size, r.text_crc32].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())


def test_odd_texts_stay_together(odd):
    check(shard_documents(odd, 4).collect(), odd.collect(), 4)


def test_a_hot_group_and_bundles(documents):
    docs = documents(["copy of a text"] * 60 + [f"text number {i} {'w' * (i % 37)}" for i in range(400)])
    rows = shard_documents(docs, 4, units=16).collect()
    check(rows, docs.collect(), 4)
    sums = defaultdict(int)
    for r in rows:
        sums[r.shard] += r.size
    assert max(sums.values()) - min(sums.values()) < 0.1 * sum(sums.values())


def test_empty(documents):
    assert shard_documents(documents([])).collect() == []
