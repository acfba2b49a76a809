"""Contamination against a direct scan; blocks, proximity and the defined cases."""

from __future__ import annotations

import random
import re

from freshet.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=13):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            q = words(t)
            n = min(width, len(q))
            for a in range(len(q) - n + 1 if q else 0):
                for s in range(len(w) - n + 1):
                    if w[s:s + n] == q[a:a + n]:
                        hit.update(range(s, s + n))
                        found.update([] if item is None else [str(item)])
        out.append((i, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect()), key=str)


def cases():
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice("xy") for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 5, 13, 14, 20, 40]))) for k in range(12)]
    items += [(3, "another text for item three"), (None, "no id here"), (50, None), (51, ""), (52, "...")]
    docs = [(k, " ".join([text(rng.randint(0, 30)), rng.choice(items)[1] or "", text(rng.randint(0, 30))])) for k in range(40)]
    docs += [(100, None), (101, ""), (102, "No ID, here!"), (102, "No ID, here!"), (None, "another TEXT for item-three"),
             (103, "é1 É1 Ab\x00cd"), (104, items[4][1] + " " + text(3000))]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = cases()
    assert got(decontam.decontaminate(*tables(spark, docs, items))) == brute(docs, items)


def test_blocks_give_the_same(spark):
    docs, items = cases()
    assert got(decontam.decontaminate(*tables(spark, docs, items), block_windows=9)) == brute(docs, items)


def test_proximity_allows_slop(spark):
    d, b = tables(spark, [(1, "alpha one beta two gamma"), (2, "gamma x beta x x x x x x alpha"), (3, "alpha gamma")], [(7, "alpha beta gamma")])
    near = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontam.decontaminate(d, b, slop=2).collect()}
    assert near == {1: (5, ["7"]), 2: (0, []), 3: (0, [])}


def test_extra_columns_empty_tables_and_stage(spark):
    d = spark.createDataFrame([(1, "a b", 9, "t"), (2, "c", 9, "t")], "doc_id long, text string, n_hit int, terms string")
    b = spark.createDataFrame([(5, "A b", 1)], "item_id long, text string, spans int")
    assert got(decontam.decontaminate(d, b)) == [(1, 2, 2, ["5"], True), (2, 1, 0, [], False)]
    assert got(decontam.decontaminate(d, b.limit(0))) == [(1, 2, 0, [], False), (2, 1, 0, [], False)]
    assert got(decontam.decontaminate(d.limit(0), b)) == []


def test_stage_drops_contaminated_rows_only(spark, monkeypatch):
    d, b = tables(spark, [(1, "a b c"), (2, None), (None, "x"), (3, "p q")], [(5, "a b c")])
    monkeypatch.setattr(decontam, "table", lambda *_: b)
    assert sorted((tuple(r) for r in decontam.clean_stage(spark, d, "").collect()), key=str) == sorted([(2, None), (None, "x"), (3, "p q")], key=str)
