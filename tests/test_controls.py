"""Prevention controls on small hand-checked inputs, plus the ordering-only operators."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from freshet.operators import baseline, controls, keys
from freshet.sources import schemas, seeds
from tests.helpers import col_values, rows


def _events(spark, data):
    return spark.createDataFrame(
        [(i, p, t, s, dt.datetime.fromisoformat(e), dt.datetime.fromisoformat(l)) for i, p, t, s, e, l in data],
        schemas.STAGING_EVENTS)


def test_ordering_operators(spark):
    cur = baseline.curated_daily_events(seeds.seed_events(spark))
    dates = col_values(baseline.curated_newest_first(cur), "event_date")
    assert dates == sorted(dates, reverse=True)
    assert col_values(baseline.lookup_ordered(seeds.seed_providers(spark).orderBy(F.desc("provider_id"))),
                      "provider_id") == [101, 102, 103, 104, 105]


def test_temp_view_registration(spark):
    seeds.seed_string_source(spark).createOrReplaceTempView("provider_string_source")
    assert spark.sql("SELECT COUNT(*) FROM provider_string_source").collect()[0][0] == 3


def test_merge_upsert_incoming_wins(spark):
    target = _events(spark, [(1, 101, "A", "APPROVED", "2024-01-01 00:00:00", "2024-01-01 00:05:00"),
                             (2, 102, "A", "APPROVED", "2024-01-01 00:00:00", "2024-01-01 00:05:00")])
    incoming = _events(spark, [(2, 102, "A", "DENIED", "2024-01-02 00:00:00", "2024-01-02 00:05:00"),
                               (2, 102, "A", "COMPLETE", "2024-01-02 00:00:00", "2024-01-02 01:05:00"),
                               (3, 103, "A", "APPROVED", "2024-01-02 00:00:00", "2024-01-02 00:05:00"),
                               (None, None, "A", "APPROVED", "2024-01-02 00:00:00", "2024-01-02 00:05:00")])
    merged = controls.merge_upsert(target, incoming)
    got = {r["event_id"]: r["status"] for r in merged.collect()}
    assert merged.count() == 4
    assert got == {1: "APPROVED", 2: "COMPLETE", 3: "APPROVED", None: "APPROVED"}


def test_idempotent_batch_load_skips_loaded_batches(spark):
    incoming = _events(spark, [(1, 1, "A", "S", "2024-01-01 00:00:00", "2024-01-01 00:05:00"),
                               (2, 1, "A", "S", "2024-01-02 00:00:00", "2024-01-02 00:05:00")])
    audit = spark.createDataFrame([("batch_2024-01-01", "STAGING_EVENTS", dt.datetime(2024, 1, 1), 1)],
                                  schemas.LOAD_AUDIT)
    out = controls.idempotent_batch_load(incoming, audit)
    assert rows(out.select("event_id", "batch_id")) == [(2, "batch_2024-01-02")]


def test_missing_days_and_files(spark):
    audit = spark.createDataFrame(
        [(f"batch_2024-01-0{d}", "STAGING_EVENTS", dt.datetime(2024, 1, d, 12), 5) for d in (1, 2, 5)],
        schemas.LOAD_AUDIT)
    assert col_values(controls.missing_load_days(audit), "missing_date") == [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    expected = spark.createDataFrame([(f"batch_2024-01-0{d}",) for d in range(1, 6)], "file_name string")
    assert col_values(controls.missing_files(expected, audit), "file_name") == ["batch_2024-01-03", "batch_2024-01-04"]
    empty = spark.createDataFrame([], schemas.LOAD_AUDIT)
    assert controls.missing_load_days(empty).count() == 0


def test_row_growth_compares_calendar_days(spark):
    ev = _events(spark, [(i, 1, "A", "S", "2024-01-01 00:00:00", ts) for i, ts in enumerate(
        ["2024-01-01 01:00:00", "2024-01-01 02:00:00", "2024-01-02 01:00:00", "2024-01-04 01:00:00"])])
    got = rows(controls.row_growth(ev))
    assert got == [(dt.date(2024, 1, 1), 2, None, None, None),
                   (dt.date(2024, 1, 2), 1, 2, -1, -0.5),
                   (dt.date(2024, 1, 4), 1, None, None, None)]


def test_contract_report_rules(spark):
    ev = _events(spark, [(1, 101, "A", "APPROVED", "2024-01-01 00:00:00", "2024-01-01 00:05:00"),
                         (1, 999, "A", "BOGUS", "2024-01-01 00:00:00", "2024-01-01 00:05:00"),
                         (2, None, "A", "DENIED", "2024-01-01 00:00:00", "2024-01-01 00:05:00")])
    rep = {(r["rule"], r["column_name"]): (r["violations"], r["passed"])
           for r in controls.contract_report(ev, seeds.seed_providers(spark), seeds.seed_string_source(spark)).collect()}
    assert rep == {("unique", "event_id"): (1, False), ("not_null", "event_id"): (0, True),
                   ("not_null", "provider_id"): (1, False), ("accepted_values", "status"): (1, False),
                   ("relationship", "provider_id"): (1, False), ("same_type", "provider_id"): (1, False)}


def test_unmatched_rate_breach(spark):
    ev = seeds.seed_events(spark)
    stg = keys.stg_provider(seeds.seed_string_source(spark, report=True))
    r = controls.unmatched_rate(ev, stg, threshold=0.05).collect()[0]
    assert (r["total_events"], r["unmatched_events"], r["unmatched_rate"], r["breach"]) == (10, 1, 0.1, True)
    r2 = controls.unmatched_rate(ev, stg, threshold=0.2).collect()[0]
    assert r2["breach"] is False


def test_anomalies_and_quota(spark):
    days = [dt.datetime(2024, 1, d, 10) for d in range(1, 10)]
    credits = [1, 1, 1, 1, 1, 1, 1, 1, 5]
    met = spark.createDataFrame([(t, "WH_1", Decimal(c)) for t, c in zip(days, credits)],
                                "start_time timestamp_ntz, warehouse_name string, credits_used decimal(18,6)")
    an = controls.usage_anomalies(met).collect()
    assert [r["is_anomaly"] for r in an] == [False] * 8 + [True]
    assert an[0]["prior_days"] == 0 and an[0]["prior_avg"] is None
    assert an[8]["prior_days"] == 7 and an[8]["prior_avg"] == 1.0
    q = controls.credit_quota_status(met, quota=10).collect()
    assert [r["quota_level"] for r in q] == [0, 0, 0, 0, 0, 0, 0, 75, 100]
    assert [r["quota_action"] for r in q][-2:] == ["NOTIFY", "SUSPEND"]


def test_long_running(spark):
    qh = spark.createDataFrame([("a", "u", "WH_1", dt.datetime(2024, 1, 1), 400000),
                                ("b", "u", "WH_1", dt.datetime(2024, 1, 1), 300000)],
                               "query_id string, user_name string, warehouse_name string, start_time timestamp_ntz, "
                               "total_elapsed_time long")
    assert col_values(controls.long_running_queries(qh, 300), "query_id") == ["a"]
