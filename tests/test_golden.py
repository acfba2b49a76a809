"""Golden values on the sample seed data (hand-computed, see FIXTURES.md §1)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.operators import baseline, duplicates, exclusion, freshness, keys
from freshet.sources import schemas, seeds
from freshet.streaming import incremental
from tests.helpers import col_values, rows

LOAD = "2026-07-24 00:00:00"


@pytest.fixture(scope="module")
def events_10(spark):
    return seeds.seed_events(spark, LOAD)


@pytest.fixture(scope="module")
def providers(spark):
    return seeds.seed_providers(spark)


@pytest.fixture(scope="module")
def events_null(spark, events_10):
    # event 10 removed; the NULL-provider event is appended without a load time (it takes the default)
    new = spark.createDataFrame([(11, None, "AUTHORIZATION", "APPROVED", dt.datetime(2026, 7, 24))],
                                "event_id long, provider_id long, event_type string, status string, "
                                "event_timestamp timestamp_ntz")
    return incremental.append_with_default_load_ts(events_10.filter("event_id <> 10"), new, LOAD)


def test_curated_from_sample(events_10):
    cur = baseline.curated_daily_events(events_10)
    got = rows(baseline.curated_ordered(cur))
    assert len(got) == 9
    assert sum(r[3] for r in got) == 10
    twos = [r for r in got if r[3] == 2]
    assert twos == [(dt.date(2026, 7, 22), "CLAIM", "COMPLETE", 2)]
    assert [(f.name, f.dataType) for f in cur.schema] == [(f.name, f.dataType) for f in schemas.CURATED_DAILY_EVENTS]


def test_curated_rollups(events_10):
    cur = baseline.curated_daily_events(events_10)
    trend = rows(baseline.event_trend(cur))
    assert [r[0] for r in trend] == sorted(r[0] for r in trend)
    assert sum(r[1] for r in trend) == 10
    st = rows(baseline.status_distribution(cur))
    assert st[0] == ("COMPLETE", 5)
    assert dict(st) == {"COMPLETE": 5, "APPROVED": 3, "DENIED": 2}
    assert dict(rows(baseline.event_type_distribution(cur))) == {"AUTHORIZATION": 5, "CLAIM": 5}


def test_replay_detect_fix(events_10):
    e20 = duplicates.replay_batch(events_10)
    assert rows(duplicates.row_count(e20)) == [(20,)]
    dk = rows(duplicates.duplicate_keys(e20))
    assert len(dk) == 10 and all(c == 2 for _, c in dk)
    assert rows(duplicates.duplication_extent(e20)) == [(20, 10, 10)]
    fixed = duplicates.dedup_keep_first(e20)
    assert fixed.count() == 10
    assert duplicates.duplicate_keys(fixed).count() == 0
    assert all(c == 1 for _, c in rows(duplicates.key_occurrences(fixed)))
    assert rows(duplicates.duplicated_key_count(e20)) == [(10,)]
    det = rows(duplicates.duplicate_details(e20))
    assert len(det) == 10 and det[0][0] == 1


def test_null_and_exclusion(events_null, providers):
    assert rows(exclusion.not_in_keys(providers, events_null)) == []
    assert col_values(exclusion.missing_keys(providers, events_null), "provider_id") == [105]
    assert col_values(exclusion.not_in_non_null(providers, events_null), "provider_id") == [105]
    assert rows(exclusion.null_key_count(events_null)) == [(1,)]
    assert col_values(exclusion.orphan_events(events_null, providers), "provider_id") == [None]
    assert rows(exclusion.unmatched_providers(events_null, providers)) == []
    assert rows(exclusion.exclusion_comparison(providers, events_null)) == [(0, 1, 1)]
    assert col_values(exclusion.distinct_keys(events_null), "provider_id") == [101, 102, 103, 104, None]
    nulls = rows(exclusion.null_key_records(events_null))
    assert len(nulls) == 1 and nulls[0][0] == 11 and nulls[0][5] == dt.datetime(2026, 7, 24)


def test_sample_data_as_shipped_has_no_missing_provider(events_10, providers):
    # the report expects 105, but with event 10 present NOT EXISTS finds none
    assert rows(exclusion.missing_keys(providers, events_10)) == []


def test_type_mismatch_script_and_report(spark, events_10):
    script = seeds.seed_string_source(spark, report=False)
    report = seeds.seed_string_source(spark, report=True)
    assert keys.naive_type_join(events_10, script).count() == 5
    assert keys.naive_type_join(events_10, report).count() == 7
    assert rows(keys.join_row_counts(events_10, report)) == [(10, 7)]
    safe = rows(keys.safe_join(events_10, report))
    assert len(safe) == 10 and sum(r[2] is not None for r in safe) == 9
    stg = keys.stg_provider(report)
    assert rows(keys.match_rate(events_10, stg)) == [(10, 9, 1)]
    assert col_values(keys.invalid_keys(report), "provider_id") == ["ABC"]
    assert rows(keys.invalid_key_count(report)) == [(1,)]
    assert dict(rows(keys.normalized_keys(report)))["104 "] == 104
    assert col_values(keys.stg_unmatched(events_10, stg), "event_id") == [10]
    lost = rows(keys.naive_unmatched(events_10, report))
    assert sorted(r[0] for r in lost) == [5, 9, 10] and all(r[2] is None and r[3] is None for r in lost)


def test_key_type_audit(spark, events_10):
    audit = rows(keys.key_type_audit(spark, events_10, seeds.seed_string_source(spark)))
    assert audit == [("staging_events", "provider_id", "bigint", False),
                     ("provider_string_source", "provider_id", "string", False)]


@pytest.fixture(scope="module")
def stale(events_10):
    return (events_10.withColumn("loaded_at", F.lit("2026-07-29 15:15:00").cast("timestamp_ntz"))
                     .withColumn("event_timestamp",
                                 F.when(F.col("event_id") == 10, F.lit("2026-07-29 15:10:00").cast("timestamp_ntz"))
                                  .otherwise(F.col("event_timestamp"))))


ASOF_STALE = "2026-07-30 15:20:00"


def test_stale_pipeline(stale):
    assert rows(freshness.latest_timestamps(stale)) == [(dt.datetime(2026, 7, 29, 15, 15), dt.datetime(2026, 7, 29, 15, 10))]
    assert rows(freshness.pipeline_health(stale, ASOF_STALE, 24)) == [("STALE",)]
    assert rows(freshness.hours_since_last_load(stale, ASOF_STALE))[0][1] == 24
    assert rows(freshness.minutes_since_last_load(stale, ASOF_STALE))[0][1] == 24 * 60 + 5
    f = rows(freshness.freshness_hours(stale, ASOF_STALE))[0]
    assert f[1] == "2026-07-29 15:15:00" and f[2] == 24.1 and f[3] == "STALE"
    cur = baseline.curated_daily_events(stale)
    status = freshness.health_status(freshness.summary_metrics(stale, cur), ASOF_STALE)
    assert col_values(status, "health_status") == ["CRITICAL"]


def test_empty_table_sql_vs_dashboard(spark):
    empty = spark.createDataFrame([], schemas.STAGING_EVENTS)
    assert rows(freshness.pipeline_health(empty, ASOF_STALE)) == [("HEALTHY",)]
    cur = baseline.curated_daily_events(empty)
    summary = freshness.summary_metrics(empty, cur)
    assert rows(summary) == [(0, 0, 0, 0, None)]
    assert col_values(freshness.health_status(summary, ASOF_STALE), "health_status") == ["CRITICAL"]
    assert rows(freshness.freshness_hours(empty, ASOF_STALE)) == [(None, "No load found", None, "UNKNOWN")]


def test_warning_when_fresh_but_dirty(events_null):
    cur = baseline.curated_daily_events(events_null)
    st = freshness.health_status(freshness.summary_metrics(events_null, cur), "2026-07-24 01:00:00")
    r = st.collect()[0]
    assert r["null_provider_ids"] == 1 and r["health_status"] == "WARNING"


def test_incremental_first_load_trap(spark, events_10):
    empty = spark.createDataFrame([], schemas.STAGING_EVENTS)
    assert incremental.incremental_by_target_max(events_10, empty).count() == 0
    assert incremental.incremental_by_target_max(events_10, empty, on_empty="all").count() == 10
    tgt = events_10.filter("event_id <= 6")
    assert sorted(col_values(incremental.incremental_by_target_max(events_10, tgt), "event_id")) == [7, 8, 9, 10]
