"""Seating, base scores against counting, probabilities against a plain sampler and summing to one, held-out perplexity."""

import glob
import math
import os
import random
import tempfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from khodat.llm import pitman_yor as P
from khodat.session import shared_root


def tokens(text):
    return (text or "").encode().lower().split() + [b" end"]


def check(docs, rows):
    texts = docs.collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    counts = Counter(t for d in texts if not held(d.doc_id) for t in tokens(d.text))
    n, v = sum(counts.values()), len(counts)
    wanted = sorted(
        ((d.doc_id, held(d.doc_id), len(tokens(d.text)), sum(t in counts for t in tokens(d.text)), n,
          round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(d.text)), 5)) for d in texts), key=str)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows), key=str)
    assert got == wanted


def test_base_scores_of_odd_texts(odd):
    rows = P.score_documents(odd).collect()
    check(odd, rows)
    assert all(r.score <= 0 for r in rows) and sorted(rows, key=str) == sorted(P.score_documents(odd).collect(), key=str)


def test_nothing_to_learn_from(documents):
    assert P.score_documents(documents([])).collect() == []
    only_held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = P.score_documents(documents(["a b"], ids=[only_held])).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(True, 3, 0, 0, 0.0, 0.0)]


def test_the_model_beats_the_base_on_held_out_documents_in_many_ranges(documents):
    rng = random.Random(8)
    texts = []
    for _ in range(600):
        kind = rng.choice("xyz")
        texts.append(" ".join(f"{rng.randrange(int(400 ** rng.random()))}{kind}en" for _ in range(40)))
    docs = documents(texts)
    scores = []
    for size in (64 << 20, 1 << 12):
        rows = P.score_documents(docs, chunk_bytes=size, range_bytes=size).collect()
        check(docs, rows)
        held = [r for r in rows if r.held_out]
        scores.append(sum(r.score for r in held))
        assert scores[-1] > 0.97 * sum(r.base_score for r in held)
    assert scores[0] == pytest.approx(scores[1], rel=0.01)


def one_range(texts):
    """All pairs of the texts as one range, everyone at one table of a dish."""
    seen = Counter()
    for text in texts:
        words = ["", *text.split(), ""]
        seen.update(zip(words[1:], words))
    words, before = sorted({w for w, _ in seen}), sorted({u for _, u in seen}, key=lambda u: (P.ending_of(u), u))
    pairs = sorted((words.index(w), before.index(u)) for w, u in seen)
    own = P.Range(
        np.arange(len(words)).astype(np.uint64), np.arange(len(before)).astype(np.uint64), np.array([P.ending_of(u) for u in before]),
        np.array([w for w, _ in pairs]), np.array([u for _, u in pairs]), np.array([seen[words[w], before[u]] for w, u in pairs]),
    )
    per_mid, per_word = np.bincount(own.low_mid), np.bincount(own.mid_word)
    seats = [P.Seating.of(c, np.ones(len(c), int)) for c in (own.counts, per_mid, per_word)]
    known = P.Totals(len(words), int(own.counts.sum()), (0.6, 0.5, 0.7), np.array([len(per_mid)]), np.array([len(words)]))
    return own, seats, known, words, before


def totals_of(own, samples):
    return own.totals([P.unpack(own.numbers(samples))[1:]])


def run(own, seats, known, rounds, kept):
    """Rounds of one sweep, totals anew after each; what the last ``kept`` leave for scoring."""
    rng, samples, held, mids, words, root = np.random.default_rng(4), [], [], [], [], []
    d, d_mid, d_root = known.discounts
    for _ in range(rounds):
        now = P.Totals(known.words, known.tokens, known.discounts, np.array([seats[2].sizes.sum()]), np.array([len(seats[2].sizes)]))
        for _ in P.seat(own, totals_of(own, [(seats[0].tables(), seats[1].tables())]), seats, now, 1, rng):
            samples.append((seats[0].tables(), seats[1].tables()))
            held.append(own.counts - d * seats[0].tables())
            mids.append(seats[1].customers() - d_mid * seats[1].tables())
            words.append(seats[2].customers() - d_root * seats[2].tables())
            root.append((seats[2].sizes.sum(), len(seats[2].sizes)))
    root = np.array(root[-kept:])
    known = P.Totals(known.words, known.tokens, known.discounts, root[:, 0], root[:, 1])
    return totals_of(own, samples[-kept:]), np.mean(held[-kept:], axis=0), mids[-kept:], words[-kept:], known


SMALL = [" ".join(f"{'ab'[i % 2]}{(i * j) % 7}{'xy'[j % 2]}" for j in range(1, 9)) for i in range(1, 30)]


def test_levels_keep_each_others_tables_and_probabilities_sum_to_one():
    own, seats, known, words, before = one_range(SMALL)
    totals, held, mids, roots, known = run(own, seats, known, 6, P.SAMPLES)
    assert (seats[0].customers() == own.counts).all()
    assert (seats[1].customers() == np.bincount(own.low_mid, seats[0].tables())).all()
    assert (seats[2].customers() == np.bincount(own.mid_word, seats[1].tables())).all()
    for u in range(len(before)):
        every = np.arange(-1, len(words))
        logs = P.log10_of(own, totals, held, mids, roots, known, every, np.full(len(every), u))
        assert (10 ** logs).sum() == pytest.approx(1, abs=1e-6)


def plain(texts, discounts, sweeps, kept):
    """The same model seated one customer at a time with every number up to date; probabilities of a word after a word."""
    rng, strength = random.Random(2), P.STRENGTH
    v = len({w for t in texts for w in [*t.split(), ""]})
    tables, customers, opened = {}, Counter(), Counter()

    def parents(u):
        return [("low", u), ("mid", P.ending_of(u)), ("root",)]

    def p(level, chain, w):
        if level == 3:
            return 1 / (v + 1)
        r = chain[level]
        own = tables.get((r, w), [])
        return (sum(own) - discounts[level] * len(own) + (strength + discounts[level] * opened[r]) * p(level + 1, chain, w)) / (strength + customers[r])

    def add(level, chain, w):
        if level == 3:
            return
        r, own = chain[level], tables.setdefault((chain[level], w), [])
        weights = [n - discounts[level] for n in own] + [(strength + discounts[level] * opened[r]) * p(level + 1, chain, w)]
        at = rng.choices(range(len(weights)), weights)[0]
        customers[r] += 1
        if at == len(own):
            own.append(1)
            opened[r] += 1
            add(level + 1, chain, w)
        else:
            own[at] += 1

    def remove(level, chain, w):
        if level == 3:
            return
        r, own = chain[level], tables[chain[level], w]
        at = rng.choices(range(len(own)), own)[0]
        customers[r] -= 1
        own[at] -= 1
        if not own[at]:
            del own[at]
            opened[r] -= 1
            remove(level + 1, chain, w)

    seated = [(parents(u), w) for t in texts for u, w in zip(["", *t.split()], [*t.split(), ""])]
    for chain, w in seated:
        add(0, chain, w)
    sums = Counter()
    asked = {(chain[0][1], w) for chain, w in seated}
    for sweep in range(sweeps):
        for chain, w in seated:
            remove(0, chain, w)
            add(0, chain, w)
        if sweep >= sweeps - kept:
            for u, w in asked:
                sums[u, w] += p(0, parents(u), w) / kept
    return sums


def test_probabilities_are_those_of_a_plain_sampler(monkeypatch):
    monkeypatch.setattr(P, "SAMPLES", 150)
    own, seats, known, words, before = one_range(SMALL)
    totals, held, mids, roots, known = run(own, seats, known, 200, 150)
    logs = P.log10_of(own, totals, held, mids, roots, known, own.low_word, own.low_before)
    wanted = plain(SMALL, known.discounts, 200, 150)
    got = {(before[u], words[w]): x for w, u, x in zip(own.low_word, own.low_before, logs)}
    assert got.keys() == wanted.keys()
    assert [got[k] for k in wanted] == pytest.approx([math.log10(x) for x in wanted.values()], abs=0.05)


def test_a_word_follows_the_one_that_it_follows_in_training(documents):
    """Not only one of the same ending: all words end alike here."""
    texts = [" ".join(f"w{(start * 3 ** i) % 101}end" for i in range(30)) for start in range(1, 300)]
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10]
    held = next(i for i in range(5000) if i >= len(texts) and zlib.crc32(str(i).encode()) % 10 == 0)
    mixed_up = " ".join(sorted(texts[5].split()))
    rows = P.score_documents(documents([*(texts[i] for i in train), texts[5], mixed_up], ids=[*train, held, held])).collect()
    good, bad = sorted((r.score for r in rows if r.held_out), reverse=True)
    assert good > bad + 20


def test_customers_leave_and_come():
    rng = np.random.default_rng(1)
    customers = np.array([5, 1, 7, 2])
    seats = P.Seating.of(np.array([3, 2, 1, 3, 3, 1, 1, 1]), np.array([2, 1, 3, 2]))
    for _ in range(200):
        at = np.flatnonzero(rng.random(4) < 0.7)
        seats.remove(at, rng)
        seats.add(at, np.full(4, 0.8), 0.5, rng)
        assert (seats.customers() == customers).all() and (seats.sizes > 0).all()
    for wanted in ([5, 1, 7, 2], [50, 3, 1, 2], [2, 1, 90, 4], [1, 1, 1, 1]):
        seats = seats.fit(np.array(wanted), np.full(4, 0.8), 0.5, rng)
        assert seats.customers().tolist() == wanted and (seats.sizes > 0).all() and (seats.tables() > 0).all()


def test_seating_follows_the_chinese_restaurant():
    """Three customers of one dish: the chance of one, two or three tables after many sweeps."""
    rng, d, fresh, n = np.random.default_rng(5), 0.5, 0.7, 20_000
    seats = P.Seating.of(np.full(n, 3), np.full(n, 1))
    for _ in range(8):
        seats = P.sweep(seats, np.full(n, fresh), d, rng)
    # With a fixed weight of a new table, the weights of partitions of three: {3}, three times {2, 1}, {1, 1, 1}.
    weights = np.array([(1 - d) * (2 - d), 3 * fresh * (1 - d), fresh * fresh])
    assert np.bincount(seats.tables(), minlength=4)[1:] / n == pytest.approx(weights / weights.sum(), abs=0.015)


def test_blocks_seat_as_single_moves_do(monkeypatch):
    """Pairs of 300 customers: the mean and spread of their tables, moved in blocks and one by one."""
    found = []
    for blocks in (32, 300):
        monkeypatch.setattr(P, "BLOCKS", blocks)
        rng, seats = np.random.default_rng(6), P.Seating.of(np.full(400, 300), np.ones(400, int))
        for _ in range(6):
            seats = P.sweep(seats, np.full(400, 4.0), 0.6, rng)
        assert (seats.customers() == 300).all()
        found.append((seats.tables().mean(), seats.tables().std()))
    assert found[0] == pytest.approx(found[1], rel=0.1)


def test_chunks_count_each_pair_once():
    c = P.Chunk.of(pa.array(["a b a b", None, "A"]), np.array([True, True, False]))
    assert c.lengths.tolist() == [5, 1, 2] and c.counts.sum() == 6 and len(c.tokens) == 8
    # After the end: the end and a; after a: the end and b; after b: the end and a.
    assert (np.diff(c.pairs) > 0).all() and len(c.pairs) == len(c.counts) == 6


def test_what_lies_on_disk_is_bounded_by_the_texts(spark, documents):
    """Stored steps and the shuffles that they took, in small ranges: 2.0 times the texts; 3.3 times when pairs were stored, and sent twice under
    their hashes."""
    rng = random.Random(3)
    texts = [" ".join(f"{rng.getrandbits(30):x}" if rng.random() < 0.1 else f"w{int(3000 ** rng.random())}" for _ in range(400)) for _ in range(500)]
    docs = documents(texts)
    folders = [shared_root(spark).removeprefix("file://"), *glob.glob(f"{tempfile.gettempdir()}/blockmgr-*")]
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept, before = spark.conf.get(setting), used(folders)
    rows = P.score_documents(docs, chunk_bytes=1 << 18, range_bytes=1 << 18)
    assert used(folders) - before < 2.6 * sum(map(len, texts))
    assert spark.conf.get(setting) == kept and rows.count() == len(texts)


def used(folders):
    return sum(os.path.getsize(os.path.join(at, f)) for folder in folders for at, _, files in os.walk(folder) for f in files)


def test_numbers_come_back_from_their_bytes():
    rng = np.random.default_rng(9)
    hashes = np.unique(rng.integers(0, 2**64 - 1, 500, np.uint64))
    assert (P.climbed(P.steps(hashes)) == hashes).all() and len(P.climbed(P.steps(hashes[:0]))) == 0
    runs = rng.integers(1, 9, 60)
    values = np.concatenate([np.sort(rng.choice(2**31, n, False)) for n in runs])
    assert (P.climbed_within(P.steps_within(values, runs), runs) == values).all()
    assert P.joined(P.planes(values)).tolist() == values.tolist()
    words = ["a", "ab", "abc", "xyzé", "", "日本"]
    assert P.endings_of(pa.array(["left out", *words])[1:]).tolist() == [P.ending_of(w) for w in words]
