"""Integer product quantisation against a plain recomputation, and the defined cases."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from freshet.llm import pqcode

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) if abs(x) < 2**52 else 256 * int(x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    w = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    kept = [(i, v + [0] * (w * parts - len(v)), lab) for i, v, lab in kept]
    first = {}
    for i, v, _ in kept:
        first[i] = min(first.get(i, v), v)
    start = [first[i] for i in sorted(first, key=lambda i: (i is None, i or 0))[:entries]]
    books = [[v[p * w:(p + 1) * w] for v in start] for p in range(parts)]

    def assign(v):
        out = []
        for p in range(parts):
            x = v[p * w:(p + 1) * w]
            out.append(min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p])))
        return out

    for _ in range(rounds):
        codes = [assign(v) for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p * w:(p + 1) * w] for (_, v, _), c in zip(kept, codes, strict=True) if c[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    codes = [assign(v) for _, v, _ in kept]
    errors = [sum(d for d, _ in c) for c in codes]
    by = {}
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by[lab] = by.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()

    def long(x):
        return x if x < 2**63 else None

    return sorted([(i, "".join(f"{e:02x}" for _, e in c), long(e), long(by[lab]), sha) for (i, _, lab), c, e in zip(kept, codes, errors, strict=True)], key=str)


@pytest.fixture()
def queried(spark, monkeypatch):
    def go(df):
        monkeypatch.setattr(pqcode, "table", lambda *_: df)
        return sorted((tuple(r) for r in pqcode.query(spark, "").collect()), key=str)
    return go


def vectors(n, dim, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(0, spread, dim)], (None, 1, 2)[i % 3]) for i in rng.permutation(n)]


def test_matches_recomputation_with_odd_rows(spark, queried):
    rows = vectors(150, 32, 1)
    rows += [(200, None, 1), (201, [None] * 32, 1), (202, [float("nan")] * 32, 1), (203, [float("inf")] + [0.0] * 31, None),
             (None, [0.25] * 32, 2), (5, [0.0] * 32, 1), rows[3], rows[3], (204, [-0.001] * 32, 1), (205, [0.5] * 20, 7), (206, [], 7)]
    assert queried(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_parts_that_are_no_power_of_two_and_few_rows(spark, queried):
    rows = vectors(90, 80, 2, 0.01)  # many ties: parts of five small integers
    assert queried(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    few = vectors(5, 16, 3)
    assert queried(spark.createDataFrame(few, SCHEMA)) == brute(few)


def test_huge_components_stay_exact(spark, queried):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 10.0 ** (i % 7 * 6), 16)], i % 4) for i in range(80)] + [(90, [1e300] * 16, 5), (91, [-3e307] * 16, 5)]
    got = queried(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows)
    assert any(r[2] is None for r in got) or any(r[3] is None for r in got)


def test_extra_columns_one_row_and_empty(spark, queried):
    df = spark.createDataFrame([(3, [0.5] * 16, 1, "x", 7)], SCHEMA + ", code string, error int")
    assert queried(df) == brute([(3, [0.5] * 16, 1)])
    assert queried(df.limit(0)) == []


def test_round_trip_and_general_layout(spark):
    rows = vectors(60, 12, 5)
    df = pqcode.usable(spark.createDataFrame(rows, SCHEMA))
    books = pqcode.train(df, parts=3, entries=100, rounds=1)  # an entry a vector: nothing is lost
    for r, (_, v, _) in zip(sorted(pqcode.encode(df, books).collect()), sorted(rows, key=lambda x: x[0]), strict=True):
        assert r["error"] == 0 and pqcode.decode(r["code"], books) == [math.floor(256 * x) for x in v]
    with pytest.raises(ValueError):
        pqcode.encode(df, [np.zeros((300, 4), np.int64)])


@pytest.mark.parametrize("length,high", [(1, 5), (4, 3), (4, 1000), (7, 40), (8, 2**45), (3, 10**25)])
def test_nearest_is_exact(length, high):
    rng = np.random.default_rng(length)
    kind = np.int64 if high < 2**50 else object
    x = np.array([[int(a) * high // 50 for a in rng.integers(-50, 50, length)] for _ in range(300)], kind)
    entries = x[rng.permutation(300)[:64]].copy()
    entries[7] = entries[20]
    index, far = pqcode.nearest(x, entries)
    d = ((x[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
    assert index.tolist() == [min(range(64), key=lambda k, r=r: (r[k], k)) for r in d] and list(map(int, far)) == list(map(int, d.min(axis=1)))


def test_sequency_order():
    for n in (1, 2, 8, 64):
        w = pqcode.hadamard(n)
        assert (w @ w.T == n * np.eye(n, dtype=int)).all() and ((np.diff(w, axis=1) != 0).sum(axis=1) == np.arange(n)).all()
