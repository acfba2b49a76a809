"""The three trained operators: held-out accuracy, parts against brute force, defined cases."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import langid, quality, toxicity

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars int, score double, v string"
ODD = [(10**7, None, None, None, None, None, None), (10**7 + 1, "", "en", "s", 0, 0.5, "x"), (10**7 + 2, "12345 !!", "en", "s", 0, 0.5, "x"),
       (None, "the and of", None, None, None, None, None), (10**7 + 3, "the " * 20000, None, None, None, None, None),
       (10**7 + 4, "ß", None, None, None, None, None), (10**7 + 4, "ß", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(0.0)).withColumn("v", F.lit("clash"))
    return base.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("int").alias("n_chars"), "score", "v").unionByName(spark.createDataFrame(ODD, DOC))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def auc(rows):
    s, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    return np.mean([(a > b) + 0.5 * (a == b) for a, b in itertools.product(s[y == 1], s[y == 0])])


def held(i, m, r):
    return i is not None and zlib.crc32(str(i).encode()) % m == r


def check_shape(rows, m, r, n):
    assert len(rows) == n and all(x["held_out"] == held(x["doc_id"], m, r) and 0 <= x["score"] <= 1 for x in rows)


def test_language(spark, docs):
    got = langid.identify(docs, langid.fit(docs)).collect()
    check_shape(got, 5, 0, docs.count())
    by = {r["doc_id"]: r for r in got}
    truth = {r["doc_id"]: r["lang"] for r in docs.filter("lang IS NOT NULL AND n_chars > 0").collect()}
    of = [by[i]["lang_pred"] == t for i, t in truth.items() if held(i, 5, 0)]
    assert np.mean(of) > 0.98
    assert by[10**7]["lang_pred"] == by[10**7 + 1]["lang_pred"] == by[10**7 + 2]["lang_pred"] == "und"
    assert all(by[10**7 + k]["score"] == 0 and by[10**7 + k]["rejected"] for k in range(3))
    assert by[10**7 + 4]["lang_pred"] in {"en", "de", "fr", "es"} and by[None]["lang_pred"] == "en"
    assert langid.identify(docs.limit(0), langid.fit(docs.limit(0))).collect() == []
    assert {r["lang_pred"] for r in langid.identify(docs, langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))).collect()} == {"und"}


def test_language_ignores_held_out_and_other_columns(spark, docs):
    twisted = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit("xx")).otherwise(F.col("lang"))) \
        .withColumn("source", F.lit("other"))
    one, two = (sorted((str(r["doc_id"]), r["lang_pred"], r["score"]) for r in langid.identify(d, langid.fit(d)).collect()) for d in (docs, twisted))
    assert one == two


def test_language_stage_keeps_clean_rows(spark, docs):
    kept = langid.keep_stage(spark, docs, "")
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns and not ids & {10**7, 10**7 + 1, 10**7 + 2}
    assert len(ids & set(range(1000))) >= 998


def test_subwords_count_like_a_loop():
    texts = [b"Ab c", b"", None, "é--é".encode(), b"a"]
    grams, starts = langid.subwords(texts)
    assert len(starts) == 5 and [int((g != langid.BUCKETS).sum()) for g in np.split(grams, starts[1:])] == [
        2 * len(b" " + b" ".join((t or b"").lower().translate(langid._LETTERS).split()) + b"   ") - 6 for t in texts]


def test_quality(spark, docs, labels):
    got = quality.classify(docs, labels).collect()
    check_shape(got, 3, 1, docs.count())
    y = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert auc([(r["score"], y[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in y]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in got)
    none = quality.classify(docs.limit(5), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5} and quality.classify(docs.limit(0), labels).collect() == []


def test_context_vectors_match_a_loop(spark):
    texts = ["a b a c", None, "", "b !! b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    index = np.zeros((quality.BUCKETS, quality.DIM))
    np.put_along_axis(index, quality.PLACE, quality.SIGN, axis=1)
    want = np.zeros_like(index)
    memo = quality._Bucket()
    for t in texts:
        ids = quality.token_buckets([t.encode() if t else None], memo)[0].tolist()
        for i, j in itertools.permutations(range(len(ids)), 2):
            if abs(i - j) <= quality.NEIGHBOURS:
                want[ids[i]] += index[ids[j]]
    assert (quality.context_vectors(df) == want).all()


def test_network_is_calibrated_on_noise():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 6))
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (rng.random(4000) < p).astype(float)
    score = quality.fit(x, y).score(x)
    for lo in (0.0, 0.25, 0.5, 0.75):
        some = (score >= lo) & (score < lo + 0.25)
        assert abs(score[some].mean() - y[some].mean()) < 0.08


def test_forward_backward_matches_all_paths():
    rng = np.random.default_rng(2)
    lengths = np.array([3, 1, 5, 2])
    e, move, start = rng.normal(size=11), rng.normal(size=(2, 2)), 0.3
    model = toxicity.Field(move=move, start=start)
    got = model.marginals(np.exp(e), lengths)
    at = 0
    for n in lengths.tolist():
        weight, total = np.zeros(n), 0.0
        for path in itertools.product((0, 1), repeat=n):
            w = np.exp(start * path[0] + sum(e[at + k] * s for k, s in enumerate(path)) + sum(move[a, b] for a, b in itertools.pairwise(path)))
            total += w
            weight += w * np.array(path)
        assert got[at:at + n] == pytest.approx(weight / total)
        at += n


def test_toxicity(spark, docs, labels):
    model = toxicity.fit(toxicity.train_rows(docs, labels, "toxic"))
    got = toxicity.tag(docs, model).collect()
    check_shape(got, 4, 2, docs.count())
    y = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert auc([(r["score"], y[r["doc_id"]]) for r in got if r["doc_id"] in y]) > 0.8
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    wrong = [r for r in got if r["predicted"] and y.get(r["doc_id"]) == 0]
    assert len(wrong) <= 0.03 * sum(v == 0 for v in y.values())
    planted = spark.createDataFrame([(1, "Nice day. You idiot, what a pathetic TRASH é idiot"), (2, "Nice day."), (3, None), (4, "é\nidiot scum moron")], "doc_id long, text string")
    tagged = {r["doc_id"]: r for r in toxicity.tag(planted, model).collect()}
    assert tagged[1]["predicted"] == tagged[4]["predicted"] == 1 and tagged[2]["predicted"] == tagged[3]["predicted"] == 0
    text = "é\nidiot scum moron"
    assert {text[s["start"]:s["end"]] for s in tagged[4]["spans"]} >= {"idiot", "scum"}
    none = toxicity.tag(docs.limit(5), toxicity.fit([])).collect()
    assert all(r["score"] < 1e-9 for r in none) and toxicity.tag(docs.limit(0), model).collect() == []


def test_toxicity_ignores_held_out_labels(spark, docs, labels):
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train_rows(docs, labels, "toxic") == toxicity.train_rows(docs, flipped, "toxic")


def test_samples_take_an_id_once_however_often_it_is_repeated(spark, docs, labels):
    from freshet.llm import common
    many = spark.range(100_000).select(F.lit(7).cast("long").alias("id"), (F.col("id") % 2).cast("int").alias("y"))
    others = spark.range(1000, 4000).select("id", F.lit(1).alias("y"))
    got = common.smallest_hashes(many.unionByName(others), "y", F.lit(500)).collect()
    ids = [r["id"] for r in got if r["y"] == 1]
    want = others.select("id").orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 40)), "id").limit(500)
    assert [r["id"] for r in got if r["y"] == 0] == [7] and len(ids) == len(set(ids)) == 500
    assert set(ids) == {r["id"] for r in want.collect()}
    # repeated documents and contradicting labels of sampled ids change neither the samples' bound nor their ids
    one = labels.filter("toxic = 1").limit(1).select("doc_id")
    again = docs.join(one, "doc_id").crossJoin(spark.range(300).select("id")).drop("id")
    other = labels.join(one, "doc_id").withColumn("toxic", F.lit(0)).withColumn("quality", F.lit(0))
    a = toxicity.train_rows(docs, labels, "toxic")
    b = toxicity.train_rows(docs.unionByName(again), labels.unionByName(other), "toxic")
    assert len(a) == len(b)
    assert langid.train_rows(docs.unionByName(again), 5).count() == langid.train_rows(docs, 5).count()


def test_empty_labels_and_documents_give_empty_samples(spark, docs, labels):
    assert toxicity.train_rows(docs.limit(0), labels, "toxic") == [] and toxicity.train_rows(docs, labels.limit(0), "toxic") == []
    assert langid.train_rows(docs.limit(0)).count() == 0


def test_sample_counts_ids_in_one_column(spark):
    from freshet.llm import common
    from tests.helpers import plan_text
    ids = spark.createDataFrame([(n % 3000 if n % 7 else None, n % 2) for n in range(6000)], "id long, y int").distinct()
    got = common.smallest_hashes(ids, "y", F.lit(5_000))
    assert len(plan_text(got)) < 30_000  # the buffer of 1,639 columns took more than 100,000 characters
    assert {r["id"] for r in got.collect()} >= {r["id"] for r in ids.collect() if r["id"] is not None}
    few = common.smallest_hashes(ids, "y", F.lit(50)).groupBy("y").count().collect()
    assert sorted((r["y"], r["count"]) for r in few) == [(0, 50), (1, 50)]
