"""The pipeline's stages, and the registration of the queries."""

from __future__ import annotations

import __spark_entry__ as entry
import corpus_pipeline
from freshet.llm import neardup, registry
from freshet.llm.common import same_row

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) == set(registry.QUERIES) and "pipeline" in entry.queries()
    assert set(registry.ORACLE) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "personal_data", "mix_sources"]


def test_stages_pass_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert out.columns == docs.columns
        now = {r["doc_id"]: r["text"] for r in out.collect()}
        assert now.keys() <= seen.keys()
        if name == "near_dedup":
            kept = {r["doc_id"] for r in neardup.near_duplicates(docs).filter("kept").collect()}
            assert now.keys() == kept and len(kept) < len(seen)
        if name == "decontaminate":
            assert 0 < len(seen) - len(now) < len(seen) // 5
        if name == "personal_data":
            assert now.keys() == seen.keys() and now != seen
        else:
            assert all(seen[i] == t for i, t in now.items())
        docs, seen = out, now
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in mixed} == seen.keys() and all(r["taken"] <= 2 * r["size"] for r in mixed)


def test_run_gives_the_mix_of_what_is_left(spark):
    one = corpus_pipeline.run(spark, SF)
    two = corpus_pipeline.run(spark, SF)
    assert one.join(two, same_row(one, two, *one.columns), "left_anti").count() == 0 and one.count() == two.count() > 100


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
