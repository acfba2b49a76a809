"""The queries that SQL can express, against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from freshet.llm import registry
from scripts.check_oracle import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(registry.ORACLE[name])
    cols, want = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(df.columns) and len(rows) == len(want)
    assert digest(df.columns, rows) == digest(cols, want)
