"""Top-k against brute force, and the defined cases."""

from __future__ import annotations

import math

import numpy as np
import pytest

from freshet.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=20):
    seen, vectors = set(), []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = tuple(math.floor(64 * float(np.float32(x))) for x in v)
        if (i, w) not in seen:
            seen.add((i, w))
            vectors.append((i, w))
    out = []
    for i, q in vectors:
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in vectors if j != i and len(c) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.fixture()
def queried(spark, monkeypatch):
    def go(df):
        monkeypatch.setattr(topk, "table", lambda *_: df)
        return sorted(tuple(r) for r in topk.query(spark, "").collect())
    return go


def test_matches_brute_force_with_ties_and_odd_rows(spark, queried):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 0.2, 12), 1)]) for i in range(150)]
    rows += [(151, None), (152, []), (153, [None] * 12), (154, [float("nan")] * 12), (155, [float("inf")] * 12), (None, [0.1] * 12),
             (160, [0.5, 0.5, 0.5]), (161, [0.25, 0.25, 0.25]), rows[20], rows[33], (40, [0.0] * 12), (200, [])]
    assert queried(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_large_components_stay_exact(spark, queried):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 10.0 ** (3 + i % 3), 5)]) for i in range(80)]
    assert queried(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_many_query_blocks_give_the_same(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(200)]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA))
    got = topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), query_block=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_pruning_compacts_and_keeps_the_best():
    rng = np.random.default_rng(4)
    q = rng.integers(-5, 6, (3, 64))
    best = topk._Best([0, 1, 2], np.array([-1, -2, -3]), q, 5)
    c = rng.integers(-5, 6, (64, 500))
    c[:, :20] = q[0][:, None] * 3  # strong candidates first: later ones are bounded away
    for a in range(0, 500, 100):
        best.add(np.arange(a, a + 100), c[:, a:a + 100])
    for j in range(3):
        want = sorted((-int(s), i) for i, s in enumerate(q[j] @ c))[:5]
        assert [(-int(s), int(i)) for s, i in zip(*best.found[j], strict=True)] == want


def test_extra_columns_and_empty_table(spark, queried):
    df = spark.createDataFrame([(0, [1.0], 5, "x"), (1, [2.0], 6, "y")], "vec_id long, embedding array<float>, score int, v string")
    assert queried(df) == [(0, 1, 1, 64 * 128)]
    assert queried(df.limit(0)) == []
