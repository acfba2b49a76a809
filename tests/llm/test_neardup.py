"""Near duplicates against all pairs, and the defined cases."""

from __future__ import annotations

import random

import pytest

from freshet.llm import neardup

SCHEMA = "doc_id long, text string"


def brute(rows, shingle=3, percent=85):
    def grams(text):
        w = (text or "").encode().lower().split()
        return frozenset(zip(*(w[k:] for k in range(shingle)))) if len(w) >= shingle else frozenset([tuple(w)] if w else [])

    sets = [(i, grams(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=str)


def got(df, **how):
    return sorted((tuple(r) for r in neardup.near_duplicates(df, **how).drop("row_key").collect()), key=str)


def corpus(seed=7, words=400):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows = []
    for _ in range(8):
        base = text(rng.randint(20, 120))
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rows += [" ".join(text(30)) for _ in range(30)]
    rng.shuffle(rows)
    return list(enumerate(rows))


ODD = [(900, None), (901, ""), (902, "  \n\t "), (903, "One"), (904, "ONE"), (905, "one two"), (906, "One\ttwo\n"), (907, "two one"),
       (908, "a b c"), (909, "A  b\x0bc"), (None, "a b c"), (None, None), (908, "a b c"), (910, "é É é"), (911, "é é é"),
       (912, "long " * 3000), (913, "long " * 4000 + "x")]


@pytest.mark.parametrize("shingle,percent", [(3, 85), (5, 80)])
def test_all_links_are_found(spark, shingle, percent):
    rows = corpus() + ODD
    assert got(spark.createDataFrame(rows, SCHEMA), shingle=shingle, percent=percent) == brute(rows, shingle, percent)


def test_large_buckets_in_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LARGE_BUCKET", 3)
    monkeypatch.setattr(neardup, "BLOCK_CLASSES", 4)
    rows = corpus(seed=11, words=60)
    rng = random.Random(5)
    base = [f"b{k}" for k in range(60)]
    for k in range(60):  # one group around a text; many members link only through others
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(60)] = f"e{k}"
        rows.append((1000 + k, " ".join(copy)))
    assert got(spark.createDataFrame(rows, SCHEMA), shingle=3, percent=85) == brute(rows)


def test_the_bound_never_drops_a_link(spark):
    """Every pair under the radius shares a key: pigeonhole over the chunks."""
    rng = random.Random(3)
    import numpy as np
    for _ in range(200):
        sig = np.array([rng.randrange(1 << 16) for _ in range(60)], np.uint16)
        other = sig.copy()
        for k in rng.sample(range(60), neardup.RADIUS):
            other[k] ^= 1
        wrong = (sig != other).reshape(neardup.CHUNKS, neardup.WIDTH).sum(axis=1)
        assert wrong.min() <= neardup.ERRORS


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d", 3, "k"), (2, "a b c d", 4, "k")], "doc_id long, text string, n int, c string")
    assert got(df, shingle=3, percent=85) == [(1, 2, 1, True), (2, 2, 1, False)]
    assert got(df.limit(0)) == []


def test_stage_keeps_one_of_each_group_with_its_columns(spark):
    rows = [(3, "a b c d e f g", "x"), (1, "A b c d e f g", "y"), (2, None, "z"), (4, "q r s t u v w", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in neardup.keep_stage(spark, df, "").collect()) == sorted(rows[1:], key=lambda r: r[0])


def test_the_radius_serves_the_similarity(spark):
    """Of the links at a similarity the radius may lose one in a million, by the binomial tail."""
    from math import comb
    for percent in range(65, 100):
        shape = neardup.layout(percent)
        assert shape.chunks * shape.width == 60 and shape.radius == 2 * shape.chunks - 1
        assert sum(comb(60, k) * (100 - percent) ** k * percent ** (60 - k) for k in range(shape.radius + 1, 61)) <= 100**60 // 10**6
    with pytest.raises(ValueError, match="50 percent"):
        neardup.near_duplicates(spark.createDataFrame([(1, "a b c")], SCHEMA), percent=50)


def test_links_between_the_old_and_the_new_radius_are_found(spark):
    """Pairs at similarity 0.8 whose signatures differ in more than 23 symbols: about one border link in 3,300."""
    import numpy as np
    words = neardup._WordHash()
    rows = []
    for k in range(100_000):
        common, mine, other = ([f"{x}{k}.{j}" for j in range(n)] for x, n in (("c", 20), ("a", 3), ("b", 2)))
        pair = [" ".join(common + mine), " ".join(common + other)]
        x, y = (neardup.signature(neardup.shingle_hashes(t.encode(), 1, words)) for t in pair)
        if 23 < np.count_nonzero(x != y) <= 29:
            rows += [(len(rows), pair[0]), (len(rows) + 1, pair[1])]
        if len(rows) == 20:
            break
    assert rows
    assert got(spark.createDataFrame(rows, SCHEMA), shingle=1, percent=80) == brute(rows, 1, 80)


def test_stage_keeps_exactly_one_row_of_each_group(spark):
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()
    near = " ".join(base[:-1] + ["zz"])
    text, far = " ".join(base), "quite another text of more than five words"
    rows = [(5, text, "s"), (5, text, "s"), (5, text, "t"),  # loaded twice, and with another source
            (5, near, "s"), (None, text, "s"), (None, near, "s"), (9, text.upper(), "s"),  # all of one group
            (5, far, "s"),  # same id, another text
            (None, "one two three four five six", "s"), (None, "One two three four five six", "s"),  # a group without ids
            (7, None, "s"), (7, None, "s"), (8, "", "s"), (None, None, "s"), (None, " ", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [tuple(r) for r in neardup.keep_stage(spark, df, "").collect()]
    assert len(out) == 7
    assert sum(t in (text, near, text.upper()) for _, t, _ in out) == 1 and {i for i, t, _ in out if t in (text, near)} == {5}
    assert (5, far, "s") in out and sum(bool(t) and t.lower().startswith("one two") for _, t, _ in out) == 1
    assert sorted((str(i), str(t)) for i, t, _ in out if not (t or "").strip()) == [("7", "None"), ("8", ""), ("None", " "), ("None", "None")]
    assert sorted(map(str, neardup.keep_stage(spark, df.repartition(5), "").collect())) == sorted(map(str, neardup.keep_stage(spark, df, "").collect()))
