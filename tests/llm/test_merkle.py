"""Merkle manifest against a plain recomputation, for two arities, and the defined cases."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from freshet.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x) -> str:
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(row, more=0) -> str:
    i, text, lang, source, n = row
    return h(*map(field, (i, source, lang, None if n is None else n + more, text)))


def ladder(digests: list[str], arity: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The last digest and, for every leaf, its (left, right) siblings level by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[a:a + arity] for a in range(0, len(digests), arity)]
        for leaf_, i in enumerate(at):
            run, slot = runs[i // arity], i % arity
            paths[leaf_].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[leaf_] = i // arity
        digests = [h(*run) for run in runs]
    return digests[0], paths


def brute(rows, arity=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((members, *ladder([leaf(r) for r in members], arity)))
    root, upper = ladder([t[1] for t in trees], arity) if trees else (None, [])
    out = []
    for (members, sub, paths), over in zip(trees, upper, strict=True):
        for r, path in zip(members, paths, strict=True):
            acc = leaf(r, 1 if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else 0)
            for a, b in path + over:
                acc = h(a, acc, b)
            out.append((r[0], leaf(r), sub, root, h(*[a + b for a, b in path + over]), acc, acc == root))
    return sorted(out, key=str)


ODD = [(None, "no id", "en", "a", 5), (None, None, None, None, None), (7, "é" * 3000, "de", "ü", 3000), (8, "", "", "", 0), (8, "", "", "", 0),
       (8, "other", "", "", 5), (9, "x", None, "s", 2**31 - 1), (10, "alone", "日本", "s", 5)]


def documents():
    return [(i, f"text {i * 37 % 11}", ("en", "de", "fr")[i % 3] if i % 5 else "en", None if i % 4 == 0 else "s", i) for i in range(100, 161)] + ODD


@pytest.fixture()
def queried(spark, monkeypatch):
    def go(df):
        monkeypatch.setattr(merkle, "table", lambda *_: df)
        return sorted((tuple(r) for r in merkle.query(spark, "").collect()), key=str)
    return go


def test_matches_recomputation(spark, queried):
    rows = documents()
    got = queried(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got == brute(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_extra_columns_one_row_and_empty(spark, queried):
    one = spark.createDataFrame([(7, "a", "en", "s", 1, "x", 2)], SCHEMA + ", leaf string, idx int")
    assert queried(one) == brute([(7, "a", "en", "s", 1)])
    assert queried(one.limit(0)) == []


@pytest.mark.parametrize("arity", [3, 5])
def test_wider_trees(spark, arity):
    rows = documents()
    made = merkle.manifest(merkle.leaves(spark.createDataFrame(rows, SCHEMA)), arity)
    want = brute(rows, arity)
    got = made.proofs.select(F.lower(F.hex("leaf")).alias("leaf"), merkle.proof_digest(F.col("path")).alias("proof"),
                             merkle.folded(F.lower(F.hex("leaf")), F.col("path")).alias("root"))
    assert sorted((r["leaf"], r["proof"], r["root"]) for r in got.collect()) == sorted((w[1], w[4], made.root) for w in want)
    assert made.root == want[0][3]
    assert {(r["subroot"]) for r in made.trees.collect()} == {w[2] for w in want}
    assert made.nodes().filter("level = 0 AND tree >= 0").count() == len(rows)


def test_one_id_over_most_rows_spreads(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 3000, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"),
                                  F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    placed = merkle.positions(merkle.stored(merkle.leaves(df), "leaves"), ["grp", "id", "leaf", "row"])
    assert sorted(r["pos"] for r in placed.select("pos").collect()) == list(range(4000))
    biggest = max(r["count"] for r in placed.groupBy("part").count().collect())
    assert placed.select("part").distinct().count() == 1 or biggest < 3000


def test_arity_is_checked(spark):
    with pytest.raises(ValueError):
        merkle.manifest(merkle.leaves(spark.createDataFrame([], SCHEMA)), 1)
