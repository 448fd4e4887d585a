"""Exact duplicates and the filters behind them."""

import hashlib
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from khodat.llm.exact import RANGE_ROWS, RUN_BITS, CountingQuotientFilter, drop_exact_duplicates, duplicate_plan, range_filters, repeated_fingerprints

FINGERPRINTS = st.lists(st.one_of(st.integers(0, 2**64 - 1), st.sampled_from([0, 1, 2**63, 2**64 - 1])), max_size=60)


@given(st.lists(FINGERPRINTS, min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_filters_merge_without_loss(parts):
    filters = [CountingQuotientFilter.of(np.array(p, np.uint64), bits=5) for p in parts]
    merged = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(f.to_bytes()) for f in filters])
    wanted = Counter(x for p in parts for x in p)
    assert dict(zip(merged.fingerprints().tolist(), merged.counts.tolist())) == wanted
    assert all(merged.count(x) == n for x, n in wanted.items()) and merged.count(12345678) == wanted[12345678]
    assert sorted(merged.repeated().tolist()) == sorted(x for x, n in wanted.items() if n > 1)


@given(st.lists(FINGERPRINTS.filter(len), min_size=1, max_size=9), st.integers(3, 40))
@settings(max_examples=60, deadline=None)
def test_ranges_hold_every_fingerprint_once(parts, range_bits):
    ranges = {}
    for p in parts:
        for r, one in range_filters(np.array(p, np.uint64), range_bits):
            ranges.setdefault(r, []).append(CountingQuotientFilter.from_bytes(one.to_bytes()))
    got = Counter()
    for r, filters in ranges.items():
        merged = CountingQuotientFilter.merge(filters)
        assert (np.diff(merged.fingerprints().astype(object)) > 0).all() and len(merged.runs) == len(filters[0].runs)
        got.update({(r << 64 - range_bits) | x: n for x, n in zip(merged.fingerprints().tolist(), merged.counts.tolist())})
    assert got == Counter(x for p in parts for x in p)


def test_a_message_does_not_grow_with_the_table():
    """Decoded, one of a table of 10 ** 10 rows takes what one of a small table takes."""
    fingerprints = np.random.default_rng(2).integers(0, 1 << 64, 2_000, np.uint64)
    for rows in (10**6, 10**8, 10**10):
        for _, one in range_filters(fingerprints, (rows // RANGE_ROWS).bit_length()):
            whole = CountingQuotientFilter.from_bytes(one.to_bytes())
            assert whole.runs.nbytes + whole.remainders.nbytes + whole.counts.nbytes <= 8 * ((1 << RUN_BITS) + 1) + 16 * 2_000


def test_repeated_fingerprints(spark):
    rows = spark.range(1000).selectExpr("id % 997 - 500 as fp")
    assert {r.fp for r in repeated_fingerprints(rows, 1000).collect()} == {-500, -499, -498}
    assert repeated_fingerprints(rows.limit(0), 0).collect() == []


def brute(rows):
    groups = {}
    for place, r in enumerate(rows):
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", r.text or ""), []).append((place, r))
    out = []
    for bare, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1].text or ""), m[1].doc_id is None, m[1].doc_id or 0, m[0]))
        for m in members:
            out.append((m[1].doc_id, best[1].doc_id, len(members), m is best, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


def test_odd_texts(odd):
    got = duplicate_plan(odd).drop("row").collect()
    assert sorted(map(tuple, got), key=str) == brute(odd.collect())
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({re.sub("[\x20\x09-\x0d]", "", r.text or "") for r in odd.collect()})


def test_empty(documents):
    assert duplicate_plan(documents([])).collect() == []
    assert drop_exact_duplicates(documents([])).collect() == []
