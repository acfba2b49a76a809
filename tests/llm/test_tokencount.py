"""Token counts against the tokenizer library on whole texts."""

from __future__ import annotations

import pytest

from freshet.llm import tokencount

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

PATH = str(public_tokenizers.path(tokencount.NAME))
SF = "/root/testdata/sf0.001"


def expected(rows):
    t = Tokenizer.from_file(PATH)
    n = [len(t.encode(s or "", add_special_tokens=False)) for _, s in rows]
    return sorted(((i, len((s or "").encode()), k, k > 1024) for (i, s), k in zip(rows, n, strict=True)), key=str)


def got(df, **how):
    return sorted((tuple(r) for r in tokencount.count_tokens(df, PATH, **how).collect()), key=str)


TEXTS = [None, "", " ", "\n\n\t ", "a<|endoftext|>b  c\n\n d <|endoftext|>", "<|endoftext|>", "<|endoftext", "it's we'll DON'T 'tis 12345 x y z",
         "日本語 テスト \U0001F600\U0001F468‍\U0001F469 ﬁ", "tab\x1csep\x1dx \x85 y", "x" * 20000, "ab " * 5000, "été Éß ñandú", "&&& *** !!\r\n\r\n  end  "]


def test_matches_the_library(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "no id")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


@pytest.mark.parametrize("head", [1, 50])
def test_the_table_size_changes_nothing(spark, head):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(spark.read.parquet(f"{SF}/documents.parquet"), head=head) == expected(rows)


def test_query_on_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in tokencount.query(spark, SF).collect()), key=str) == expected(rows)


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", 7)], "doc_id long, text string, n_tokens int")
    assert got(df) == [(1, 3, 2, False)] and got(df.limit(0)) == []
