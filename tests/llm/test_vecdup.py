"""Metric range join of vectors against brute force, with cells and blocks small enough to matter."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import vecdup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    seen = {}
    for i, v, lab in rows:
        if i is None or lab is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        seen.setdefault((i, lab, tuple(float(np.float32(x)) for x in v)), len(seen))
    keys = list(seen)
    unit = [np.array(k[2]) / np.linalg.norm(np.array(k[2]) / max(map(abs, k[2]))) / max(map(abs, k[2])) for k in keys]
    link = [[b for b in range(len(keys)) if b != a and keys[a][1] == keys[b][1] and len(unit[a]) == len(unit[b])
             and unit[a] @ unit[b] >= cosine] for a in range(len(keys))]
    comp = list(range(len(keys)))
    for a in range(len(keys)):
        if comp[a] == a:
            stack, reach = [a], {a}
            while stack:
                for b in link[stack.pop()]:
                    if b not in reach:
                        reach.add(b)
                        stack.append(b)
            for b in reach:
                comp[b] = a
    low = {}
    for a, k in enumerate(keys):
        low[comp[a]] = min(low.get(comp[a], k[0]), k[0])
    out = []
    for i, v, lab in rows:
        a = seen.get((i, lab, tuple(float(np.float32(x)) for x in v))) if v and None not in v else None
        if a is None:
            out.append((i, 0, i, True))
        else:
            out.append((i, len(link[a]), low[comp[a]], i == low[comp[a]]))
    return sorted(out, key=str)


def clustered(n, dim, seed, centres=6, spread=(0.05, 0.35), labels=2):
    """Clusters of several widths (chains of links included), loose vectors and a large group of near copies."""
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    rows = []
    for i in rng.permutation(n).tolist():
        k = 0 if i % 3 == 0 else i % centres
        x = rng.normal(size=dim) if i % 4 == 1 else c[k] + rng.normal(size=dim) * rng.uniform(*spread)
        rows.append((i, [float(y) for y in x * rng.uniform(0.1, 5)], int(i % labels)))
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def small(monkeypatch):
    for name, value in (("CELL", 20), ("PIVOTS", 5), ("BLOCK", 16), ("DEALT", 50), ("STEP", 7)):
        monkeypatch.setattr(vecdup, name, value)


@pytest.mark.parametrize("dim,seed", [(4, 1), (16, 2)])
def test_matches_brute_force_over_cells_and_blocks(spark, small, dim, seed):
    rows = clustered(400, dim, seed)
    want = brute(rows)
    assert sum(r[1] for r in want) > 400 and any(not r[3] for r in want)
    assert got(vecdup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))) == want


def test_every_pair_meets_in_one_cell(spark, small):
    rows = clustered(300, 3, 3, labels=1)
    _, classes = vecdup.classes_of(spark.createDataFrame(rows, SCHEMA))
    classes = vecdup.stored(classes, "classes")
    t = math.sqrt(2 - 2 * 0.93) + vecdup.MARGIN
    cells = vecdup.stored(vecdup.cells(vecdup.stored(vecdup.packed(classes), "members"), t, "<f4"), "cells")
    sizes = vecdup.cell_sizes(cells)
    assert sizes.count() > 10 and sizes.agg(F.max("homes")).first()[0] < 300
    homes = cells.filter("home").groupBy("c").count()
    assert homes.count() == 300 and homes.filter("count > 1").isEmpty()
    meetings = {}
    for r in cells.groupBy("cell").agg(F.collect_list(F.when(F.col("home"), F.col("c"))).alias("h"), F.collect_list(F.when(~F.col("home"), F.col("c"))).alias("o")).collect():
        for a, x in enumerate(r["h"]):
            for y in r["h"][a + 1:] + r["o"]:
                pair = min(x, y), max(x, y)
                meetings[pair] = meetings.get(pair, 0) + 1
    assert max(meetings.values()) == 1
    # fewer comparisons than all pairs, and no linked pair without a meeting
    u = {r["c"]: np.array(r["v"]) / np.linalg.norm(r["v"]) for r in classes.collect()}
    ids = sorted(u)
    assert all((a, b) in meetings for k, a in enumerate(ids) for b in ids[k + 1:] if u[a] @ u[b] >= 0.93)
    assert len(meetings) < 300 * 299 / 2


def test_copies_repeats_and_odd_rows(spark, small):
    v = [0.5, -0.25, 1.0]
    rows = [(i, v, 1) for i in range(60)] + [(5, v, 1), (5, v, 1), (70, [x * 3 for x in v], 1), (71, v, 2), (71, [-x for x in v], 2), (72, v, None),
            (73, None, 1), (74, [], 1), (75, [0.0] * 3, 1), (76, [0.5, None, 1.0], 1), (77, [float("nan")] * 3, 1), (78, [float("inf"), 0.0, 0.0], 1),
            (None, v, 1), (79, v + [0.0], 1), (80, v + [0.0], 1), (81, [1e-42, 0.0, 0.0], 3), (82, [3e38, 1e30, 0.0], 3), (3, [1.0, 0.0, 0.0], 1)]
    assert got(vecdup.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_doubles_extra_columns_and_empty(spark, monkeypatch):
    rows = [(1, [1e200, 0.0], "a", 5), (2, [1.0, 0.1], "a", 6), (3, [1.0, 0.1], "b", 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, n_links int")
    monkeypatch.setattr(vecdup, "table", lambda *_: df)
    assert got(vecdup.query(spark, "")) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    monkeypatch.setattr(vecdup, "table", lambda *_: df.limit(0))
    assert got(vecdup.query(spark, "")) == []
    with pytest.raises(ValueError):
        vecdup.near_duplicates(df, 1.0)
