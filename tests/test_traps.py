"""Dialect and semantics traps."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.functions import (format_ts, freshness_hours_expr, hours_crossed, minutes_crossed, ntz,
                               to_number_or_null, normalize_key, since)
from freshet.operators import baseline, duplicates, exclusion, explorer, freshness, keys, usage
from freshet.sources import schemas, seeds
from tests.helpers import col_values, rows


def test_hour_boundaries_not_elapsed_hours(spark):
    df = spark.range(1).select(
        hours_crossed(ntz("2024-01-01 15:59:00"), ntz("2024-01-01 16:01:00")).alias("h"),
        F.timestamp_diff("HOUR", ntz("2024-01-01 15:59:00"), ntz("2024-01-01 16:01:00")).alias("elapsed"),
        minutes_crossed(ntz("2024-01-01 15:59:59"), ntz("2024-01-01 16:00:00")).alias("m"))
    assert rows(df) == [(1, 0, 1)]


def test_tolerant_number_parse(spark):
    df = spark.createDataFrame([("101.6",), ("1e2",), (" 104 ",), ("104 ",), ("ABC",), (None,), ("",)], "s string")
    got = col_values(df.select(to_number_or_null("s").alias("n")), "n")
    assert got == [102, 100, 104, 104, None, None, None]
    assert col_values(df.select(normalize_key("s").alias("n")), "n") == got


def test_freshness_rounds_half_even(spark):
    # 0.25 h = 15 min: Python's round gives 0.2 (half-even); Spark's round would give 0.3
    df = spark.range(1).select(freshness_hours_expr(ntz("2024-01-01 00:00:00"), "2024-01-01 00:15:00").alias("h"),
                               freshness_hours_expr(F.lit(None).cast("timestamp_ntz"), "2024-01-01").alias("n"))
    assert rows(df) == [(0.2, None)]


def test_format_ts_truncates_and_defaults(spark):
    df = spark.range(1).select(format_ts(ntz("2024-01-02 03:04:05.987")).alias("a"),
                               format_ts(F.lit(None).cast("timestamp_ntz")).alias("b"))
    assert rows(df) == [("2024-01-02 03:04:05", "No load found")]


def test_rows_without_a_load_time_have_no_prior_day(spark):
    from freshet.operators import controls
    df = spark.createDataFrame([(None,), (None,), (dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),), (dt.datetime(2024, 1, 2),)],
                               "loaded_at timestamp_ntz")
    assert rows(controls.row_growth(df)) == [(dt.date(2024, 1, 1), 1, None, None, None), (dt.date(2024, 1, 2), 2, 1, 1, 1.0),
                                             (None, 2, None, None, None)]


def test_lookback_is_inclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30),), (dt.datetime(2024, 1, 29, 23, 59),)], "ts timestamp_ntz")
    assert df.filter(F.col("ts") >= since("2024-01-31 00:00:00", 1, "day")).count() == 1


def _not_in_cases(spark):
    dim = lambda vals: spark.createDataFrame([(v,) for v in vals], "provider_id long")
    ev = lambda vals: spark.createDataFrame([(v,) for v in vals], "provider_id long")
    return [
        (dim([1, 2, None]), ev([1])),            # NULL outer key
        (dim([1, 2, 3]), ev([1, None])),         # NULL in the subquery
        (dim([1, None]), ev([])),                # empty subquery keeps everything
        (dim([1, 2]), ev([None, None])),         # all-NULL subquery
        (dim([1, 2, 3]), ev([2, 2, 5])),         # plain
    ]


def test_not_in_matches_spark_three_valued_logic(spark):
    for i, (d, e) in enumerate(_not_in_cases(spark)):
        d.createOrReplaceTempView(f"d{i}")
        e.createOrReplaceTempView(f"e{i}")
        expected = sorted(col_values(spark.sql(
            f"SELECT provider_id FROM d{i} WHERE provider_id NOT IN (SELECT provider_id FROM e{i})"), "provider_id"),
            key=lambda v: (v is None, v))
        got = sorted(col_values(exclusion.not_in_keys(d, e), "provider_id"), key=lambda v: (v is None, v))
        assert got == expected, i
        expected_nn = sorted(col_values(spark.sql(
            f"SELECT provider_id FROM d{i} WHERE provider_id NOT IN "
            f"(SELECT provider_id FROM e{i} WHERE provider_id IS NOT NULL)"), "provider_id"),
            key=lambda v: (v is None, v))
        got_nn = sorted(col_values(exclusion.not_in_non_null(d, e), "provider_id"), key=lambda v: (v is None, v))
        assert got_nn == expected_nn, i
        cmp = rows(exclusion.exclusion_comparison(d, e))[0]
        assert cmp[0] == len(expected)


def test_dedup_null_load_time_never_wins(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, dt.datetime(2024, 1, 2), "b"), (1, dt.datetime(2024, 1, 3), "c")],
                               "event_id long, loaded_at timestamp_ntz, tag string")
    assert col_values(duplicates.dedup_keep_first(df), "tag") == ["b"]


def test_duplicate_null_key_forms_one_group_but_is_not_distinct(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "event_id long")
    assert rows(duplicates.duplicate_keys(df)) == [(None, 2)]
    assert rows(duplicates.duplication_extent(df)) == [(3, 1, 2)]


def test_explorer_limit_first_then_filter(spark):
    base = [(i, 100 + i, "CLAIM" if i % 2 else "AUTHORIZATION", "APPROVED",
             dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), dt.datetime(2024, 1, 2)) for i in range(20)]
    df = spark.createDataFrame(base, schemas.STAGING_EVENTS)
    got = explorer.explorer_filter(df, ["CLAIM"], ["APPROVED"], n=10)
    # newest 10 are ids 10..19; of those the odd ones are claims
    assert sorted(col_values(got, "event_id")) == [11, 13, 15, 17, 19]
    assert explorer.explorer_filter(df, [], ["APPROVED"], n=10).count() == 0
    assert explorer.clamp_limit(0) == 1 and explorer.clamp_limit(5000) == 1000 and explorer.clamp_limit("7") == 7
    top = col_values(explorer.recent_events(df, 3), "event_id")
    assert top == [19, 18, 17]


def test_facets_skip_nulls_and_sort(spark):
    df = spark.createDataFrame([("b", "X"), ("a", None), (None, "Y"), ("a", "X")], "event_type string, status string")
    assert rows(explorer.facet_values(df)) == [("event_type", "a"), ("event_type", "b"), ("status", "X"), ("status", "Y")]


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2)], "A long, Bb long")
    low = explorer.normalize_columns(df)
    assert low.columns == ["a", "bb"]
    assert explorer.select_available(low, ["bb", "zz", "a"]).columns == ["bb", "a"]


def test_bare_integer_string_join_fails_but_naive_join_reproduces_the_effect(spark):
    ev, src = seeds.seed_events(spark), seeds.seed_string_source(spark)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ev.join(src, ev["provider_id"] == src["provider_id"]).collect()
    assert keys.naive_type_join(ev, src).count() == 5


def test_sql_check_is_strict_but_dashboard_rounds(spark):
    df = spark.createDataFrame([(1, 1, "A", "S", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0))],
                               schemas.STAGING_EVENTS)
    asof = "2024-01-02 00:02:00"  # 24 h 2 min after the load
    assert rows(freshness.pipeline_health(df, asof, 24)) == [("STALE",)]
    f = rows(freshness.freshness_hours(df, asof))[0]
    assert f[2] == 24.0 and f[3] == "WITHIN_SLA"


def test_top_k_puts_null_bytes_last(spark):
    qh = spark.createDataFrame(
        [("a", "u", "WH_1", "SELECT", "q", dt.datetime(2024, 1, 30, 12), dt.datetime(2024, 1, 30, 12, 1), 5, None, 1, "SUCCESS"),
         ("b", "u", "WH_1", "SELECT", "q", dt.datetime(2024, 1, 30, 12), dt.datetime(2024, 1, 30, 12, 1), 5, 10, 1, "SUCCESS"),
         ("c", "u", "WH_1", "SELECT", "q", dt.datetime(2024, 1, 30, 12), dt.datetime(2024, 1, 30, 12, 1), 5, 10, 1, "SUCCESS")],
        schemas.QUERY_HISTORY)
    got = col_values(usage.expensive_queries(qh, "2024-01-31 00:00:00", n=3), "query_id")
    assert got == ["b", "c", "a"]


def test_event_dates_do_not_shift_with_the_session_zone(spark):
    ev = seeds.seed_events(spark)
    utc = rows(baseline.curated_ordered(baseline.curated_daily_events(ev)))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = rows(baseline.curated_ordered(baseline.curated_daily_events(ev)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert other == utc
