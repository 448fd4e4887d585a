"""Vector near duplicates against all pairs."""

import math

import numpy as np
import pytest

from khodat.llm.common import stored
from khodat.llm.vectors import local_roots, near_vectors, passes_for


def brute(rows):
    ok = {}
    for i, r in enumerate(rows):
        v = r.embedding
        if r.label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = np.array(v, float) / max(abs(x) for x in v)
            ok[i] = v / np.sqrt(v @ v)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ok:
        for j in ok:
            if i < j and rows[i].label == rows[j].label and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                root[find(j)] = find(i)
    least = {}
    for i, r in enumerate(rows):
        if r.vec_id is not None:
            least[find(i)] = min(least.get(find(i), r.vec_id), r.vec_id)
    return sorted(((r.vec_id, links[i], least.get(find(i)), r.vec_id is not None and r.vec_id == least.get(find(i))) for i, r in enumerate(rows)), key=str)


def table(spark, rows, kind="float"):
    return stored(spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, raw string, `group` int").coalesce(3), "vectors")


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_vectors(spark, kind):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.1], [-1.0, 0.0], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], None, [], [1.0], [5.0], [1e30, 1e29], [-0.0, 1.0], [0.0, 1.0]]
    rows = [(i, v, label) for label in (1, 2, None) for i, v in enumerate(vectors, 100 * (label or 0))] + [(None, [1.0, 0.0], 1), (100, [1.0, 0.0], 1)]
    vectors = table(spark, rows, kind)
    assert sorted(map(tuple, near_vectors(vectors).drop("row").collect()), key=str) == brute(vectors.collect())


def test_clusters_of_many_sizes_and_small_blocks(spark):
    rng = np.random.default_rng(4)
    rows = []
    for label, n in ((0, 40), (1, 4), (0, 4), (1, 1)):
        for c in range(6):
            base = rng.normal(size=16)
            rows += [(len(rows) + k, (base + rng.normal(size=16) * 0.11).tolist(), label) for k in range(n)]
    rows += [(1000 + i, rows[5][1], 0) for i in range(60)]
    vectors = table(spark, rows)
    assert sorted(map(tuple, near_vectors(vectors, window=8, block=16).drop("row").collect()), key=str) == brute(vectors.collect())


def test_no_pair_is_lost_in_a_dense_region(spark):
    """All vectors of a label at a cosine of about 0.95, 200 pairs among them at 0.982."""
    rng = np.random.default_rng(6)
    turned = lambda v, cosine: cosine * v + math.sqrt(1 - cosine**2) * rng.normal(size=v.shape) / 8
    dense = turned(np.tile(np.eye(64)[0], (3000, 1)), math.sqrt(0.95))
    dense[:200] = turned(dense[200:400], 0.982)
    unit = dense / np.linalg.norm(dense, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.98).sum(1) - 1
    vectors = table(spark, [(i, v.tolist(), 1) for i, v in enumerate(dense)], "double")
    assert {r.vec_id: r.n_links for r in near_vectors(vectors, window=16, block=256).collect()} == dict(enumerate(links.tolist())) and links.sum() > 200


def test_empty(spark):
    assert near_vectors(table(spark, [])).collect() == []
    assert [tuple(r)[1:] for r in near_vectors(table(spark, [(3, None, 1)])).collect()] == [(3, 0, 3, True)]


def test_passes_grow_slowly():
    assert [passes_for(n) for n in (0, 1, 64)] == [1, 1, 1] and passes_for(10**5) < passes_for(10**9) < 70


def test_local_roots():
    assert local_roots(6, np.array([0, 4, 3]), np.array([3, 5, 4])).tolist() == [0, 1, 2, 0, 0, 0]
