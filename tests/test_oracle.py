"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from freshet.plans.queries import QUERIES as OWN
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in E.queries().items() if name in OWN}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_date", "event_type", "status", "event_count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    o_cols, o_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows) == digest(o_cols, o_rows)
