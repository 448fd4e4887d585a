"""Targets by water-filling and the repetitions that reach them."""

from collections import defaultdict

import pytest

from khodat.llm.mixing import count_words, mix, mix_digest, mix_plan, water_fill


def targets(sizes, weights, most):
    """Clamping in rounds, one at a time."""
    total, fixed = sum(sizes), {}
    while True:
        rest = [i for i in range(len(sizes)) if i not in fixed]
        left, weight = total - sum(fixed.values()), sum(weights[i] for i in rest)
        above = [i for i in rest if weight and left * weights[i] / weight > most * sizes[i] + 1e-9]
        if not above:
            return [fixed.get(i, left * weights[i] / weight if weight else 0) for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in above}


@pytest.mark.parametrize("sizes", [[10, 1000, 1000], [1, 1, 1, 997], [5, 5, 5], [0, 7, 9], [0, 0], [3]])
def test_water_fill(spark, sizes):
    weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
    rows = spark.createDataFrame([(str(i), s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight double")
    got = {r.source: r.target for r in water_fill(rows).collect()}
    assert [got[str(i)] for i in range(len(sizes))] == pytest.approx(targets(sizes, weights, 3))


def test_words_taken_come_near_the_targets(documents):
    texts = [" ".join(["w"] * (1 + (i * 37) % 90)) for i in range(900)]
    sources = [None if i % 10 == 9 else ["b", "B", "é", "hot"][min(i % 7, 3)] for i in range(900)]
    docs = documents(texts, sources=sources)
    rows = mix_digest(docs).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix_digest(docs).collect()))
    assert sorted((r.doc_id, r["size"]) for r in rows) == [(i, len(t.split())) for i, t in enumerate(texts)]
    source_of, taken, target, size = dict(enumerate(sources)), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        s = source_of[r.doc_id]
        taken[s] += r.taken
        size[s] += r["size"]
        target[s] = r.target
        assert r.taken % r["size"] == 0 and r.taken <= 3 * r["size"]
    order = sorted((s for s in size if s is not None)) + [None]
    assert [target[s] for s in order] == pytest.approx(targets([size[s] for s in order], [(5.0, 2.0, 1.0)[i % 3] for i in range(5)], 3))
    assert all(abs(taken[s] - target[s]) <= 90 for s in size) and all(r.source_size == size[source_of[r.doc_id]] for r in rows)
    mixed = mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.repeats for r in rows)


def test_odd_texts(odd):
    rows = mix_plan(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.repeats <= 3 for r in rows)
    assert {r.doc_id: r["size"] for r in rows if r.doc_id in (0, 2, 5, 9, 11)} == {0: 0, 2: 0, 5: 2, 9: 4, 11: 2}
    assert mix(odd).columns == odd.columns


def test_nothing_to_mix(documents):
    assert mix_plan(documents([])).collect() == [] and mix(documents([])).collect() == []
    assert [(r.target, r.repeats) for r in mix_plan(documents([None, " "])).collect()] == [(0.0, 0)] * 2


def test_words_are_split_at_ascii_white_space(spark):
    rows = spark.createDataFrame([("a\x0bb\x0cc\x1cd\u00a0e",), (None,), ("",)], "text string").select(count_words("text"))
    assert [r[0] for r in rows.collect()] == [3, 0, 0]
