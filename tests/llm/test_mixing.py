"""The mix: targets, exact totals, caps, reruns, and the blocks behind the totals."""

from __future__ import annotations

import numpy as np
import pytest

from freshet.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def docs(spark):
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(["w"] * int(rng.integers(1, 60))), "hot" if k % 3 == 0 else f"s{k % 7}") for k in range(400)]
    rows += [(500, None, "s1"), (501, "", None), (502, "one two", None), (503, " \t\n", "s2"), (504, "x " * 5000, "s3"), (None, "a b c", "s4"),
             (7, "repeated row", "s5"), (7, "repeated row", "s5")]
    return spark.createDataFrame(rows, SCHEMA)


def size(text):
    return len((text or "").encode().split())


def test_targets_fill_up_to_the_cap():
    assert mixing.targets([10, 10, 10], [3, 1, 2]) == pytest.approx([20, 25 / 3, 50 / 3])
    assert mixing.targets([0, 100], [3, 1]) == pytest.approx([0, 150])
    assert mixing.targets([], []) == [] and mixing.targets([0], [3]) == [0]
    got = mixing.targets([5, 1000, 40, 7], [3, 1, 2, 3])
    assert sum(got) == pytest.approx(1.5 * 1052) and all(t <= 2 * n + 1e-9 for t, n in zip(got, [5, 1000, 40, 7], strict=True))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation_is_a_bijection_with_an_inverse(n):
    p = mixing.permute(np.arange(n), n, 1, 2, 3)
    assert sorted(p.tolist()) == list(range(n))
    assert (mixing.permute(p, n, 1, 2, 3, back=True) == np.arange(n)).all()


def test_shards_share_out_the_quotas():
    totals = np.array([130, 0, 71, 9])
    shards = [mixing.shard_counts(totals, 5, 42, s, 8) for s in range(5)]
    assert sum(c for _, c in shards).tolist() == totals.tolist()
    assert all(c.sum() == 42 for _, c in shards)
    for a, b in zip(shards, shards[1:], strict=False):
        assert (a[0] + a[1] == b[0]).all()


@pytest.mark.parametrize("block", [7, 64, 2048])
def test_taken_words_meet_targets_and_caps(spark, block):
    df = docs(spark)
    rows = mixing.mix(df, block_words=block).taken().collect()
    texts = df.collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(r["doc_id"]), size(r["text"])) for r in texts)
    names = sorted({r["source"] for r in texts} - {None}) + [None]
    sizes = [sum(size(r["text"]) for r in texts if r["source"] == s) for s in names]
    goal = mixing.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))])
    for s, n, t in zip(names, sizes, goal, strict=True):
        of = [r for r in rows if r["source"] == s]
        assert {(r["source_size"], round(r["target"], 6)) for r in of} == {(n, round(t, 6))}
        assert sum(r["taken"] for r in of) == round(t)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)


def test_reruns_agree_whatever_the_partitions(spark):
    df = docs(spark)
    key = lambda d: sorted((tuple(r) for r in mixing.mix(d).taken().collect()), key=str)
    assert key(df) == key(df.repartition(7))


def test_blocks_hold_the_taken_words(spark):
    m = mixing.mix(docs(spark), block_words=64)
    held = {}
    for r in m.blocks().collect():
        assert 0 <= r["word_from"] < r["word_to"]
        held[r["source"], r["doc_id"]] = held.get((r["source"], r["doc_id"]), 0) + r["word_to"] - r["word_from"]
    want = {}
    for r in m.taken().collect():
        if r["taken"]:
            want[r["source"], r["doc_id"]] = want.get((r["source"], r["doc_id"]), 0) + r["taken"]
    assert held == want
    slots = m.slots.collect()
    assert len({(r["shard"], r["slot"]) for r in slots}) == len(slots)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "a b", "s", 4, 5)], SCHEMA + ", size int, start int")
    assert [tuple(r) for r in mixing.mix(df).taken().collect()] == [(1, 2, "s", 2, 3.0, 3)]
    assert mixing.mix(df.limit(0)).taken().collect() == []


def test_shards_are_drawn_at_every_size():
    import math
    for totals in (np.array([300, 100, 200]), np.array([3 * 10**9, 10**9, 2 * 10**9, 5]), np.array([0, 7 * 10**12, 1])):
        shards = -(-int(totals.sum()) // 1024)
        at = [0, 1, shards // 2, shards - 1] if shards > 4 else range(shards)
        for shard in at:
            first, count = mixing.shard_counts(totals, shards, 1024, shard, 3)
            again = mixing.shard_counts(totals, shards, 1024, shard, 3)
            assert (first == again[0]).all() and (count == again[1]).all()
            assert int(count.sum()) == min(1024, int(totals.sum()) - shard * 1024) and (first + count <= totals).all() and (count >= 0).all()
    # the spread of a large draw is that of drawing without replacement, not that of proportional parts
    count, room = np.array([3 * 10**9, 10**9, 2 * 10**9]), 10**9
    drawn = np.array([mixing.draw(count, room, np.random.default_rng(k)) for k in range(400)])
    assert (drawn.sum(axis=1) == room).all()
    for i, c in enumerate(count.tolist()):
        p, n = c / count.sum(), int(count.sum())
        want = math.sqrt(room * p * (1 - p) * (n - room) / (n - 1))
        assert abs(drawn[:, i].mean() - room * p) < 5 * want / math.sqrt(400) and 0.8 < drawn[:, i].std() / want < 1.2
    small = np.array([mixing.draw(np.array([30, 10, 20]), 10, np.random.default_rng(k)) for k in range(2000)])
    assert abs(small.mean(axis=0) - np.array([5, 10 / 6, 10 / 3])).max() < 0.15 and (small.sum(axis=1) == 10).all()
