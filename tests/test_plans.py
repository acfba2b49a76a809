"""Plan-shape checks: the physical plans the operators are designed to produce."""

from __future__ import annotations

import re

import pytest

from freshet.operators import baseline, controls, duplicates, exclusion, explorer, freshness, keys, usage
from freshet.sources import sinks
from freshet.sources import tables as T
from freshet.streaming import incremental
from tests.helpers import plan_text

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_native_not_in_broadcasts_events_but_ours_does_not(spark, no_auto_broadcast):
    dim = T.dim_provider_lookup(spark, SF)
    ev = T.staging_events(spark, SF)
    dim.createOrReplaceTempView("dim_p")
    ev.createOrReplaceTempView("stg_e")
    native = spark.sql("SELECT provider_id FROM dim_p WHERE provider_id NOT IN (SELECT provider_id FROM stg_e)")
    assert "BroadcastHashJoin" in plan_text(native)  # the trap: the event side is broadcast regardless
    ours = plan_text(exclusion.not_in_keys(dim, ev))
    assert "BroadcastHashJoin" not in ours and "BroadcastExchange" not in ours
    # the NOT IN semantics come from a one-row aggregate used as scalar subqueries, not a join
    assert "Subquery" in ours
    assert "BroadcastNestedLoopJoin" not in ours and "CartesianProduct" not in ours
    assert sorted(r[0] for r in native.collect()) == sorted(r[0] for r in exclusion.not_in_keys(dim, ev).collect())


def test_top_k_reports_do_not_sort_globally(spark):
    ev = T.staging_events(spark, SF)
    qh = T.query_history(spark, SF)
    for df in (explorer.recent_events(ev, 100), usage.expensive_queries(qh, "2024-01-31 00:00:00"),
               usage.recent_queries(qh, "WH_1")):
        text = plan_text(df)
        assert "TakeOrderedAndProject" in text
        assert "rangepartitioning" not in text.lower()


def test_dedup_limits_rows_per_key_before_the_shuffle(spark):
    plan = plan_text(duplicates.dedup_keep_first(T.staging_events_dup(spark, SF)))
    head = plan.split("\n\n")[0]
    assert head.count("WindowGroupLimit") == 2
    # the partial limit sits below the exchange
    assert head.index("Exchange") < head.rindex("WindowGroupLimit")


def test_lookback_bound_reaches_the_scan(spark):
    plan = plan_text(usage.warehouse_credits(T.warehouse_metering_history(spark, SF), "2024-01-31 00:00:00"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plan)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_watermark_is_a_literal_filter_in_the_scan(spark):
    df = incremental.incremental_by_control(T.source_events(spark, SF), T.pipeline_control(spark), "EVENT_PIPELINE")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts,", plan_text(df))


def test_summary_scans_staging_once(spark):
    ev = T.staging_events(spark, SF)
    cur = spark.createDataFrame([], "event_date date, event_type string, status string, event_count long")
    plan = plan_text(freshness.summary_metrics(ev, cur))
    assert len(re.findall(r"(?m)^\(\d+\) Scan parquet", plan)) == 1
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("build", [
    lambda ev, dim, src: exclusion.orphan_events(ev, dim), lambda ev, dim, src: keys.naive_unmatched(ev, src),
    lambda ev, dim, src: keys.safe_join(ev, src), lambda ev, dim, src: keys.safe_join(ev, src, trim=False),
    lambda ev, dim, src: keys.stg_provider_join(ev, keys.stg_provider(src)),
    lambda ev, dim, src: keys.stg_unmatched(ev, keys.stg_provider(src))])
def test_null_keys_are_salted_in_one_scan(spark, no_auto_broadcast, build):
    plan = plan_text(build(T.staging_events(spark, SF), T.dim_provider_lookup(spark, SF), T.provider_string_source(spark, SF)))
    head = plan.split("\n\n")[0]
    assert "Union" not in head and head.count("SortMergeJoin") == 1
    assert len(re.findall(r"(?m)^Location:.*events\.parquet", plan)) == 1
    # the left side is dealt by (key, salt)
    assert re.search(r"hashpartitioning\([^)]*__ls", plan)


def test_controls_read_only_their_window(spark):
    asof = "2024-01-31 00:00:00"
    metering, history = T.warehouse_metering_history(spark, SF), T.query_history(spark, SF)
    for df in (controls.usage_anomalies(metering, asof=asof, days=1), controls.credit_quota_status(metering, asof=asof, days=3),
               controls.long_running_queries(history, 60, asof=asof, days=1), controls.bytes_anomalies(history, asof=asof, days=1)):
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plan_text(df))


def test_controls_prune_date_partitions(spark, scratch):
    path = sinks.write_date_partitioned(T.warehouse_metering_history(spark, SF), f"{scratch}/metering", "start_time", "start_date")
    stored = spark.read.parquet(path)
    plan = plan_text(controls.usage_anomalies(stored, asof="2024-01-31 00:00:00", days=1, date_col="start_date"))
    assert re.search(r"PartitionFilters: \[[^\]]*start_date", plan)


def test_curated_is_partial_then_final_aggregate(spark):
    plan = plan_text(baseline.curated_daily_events(T.staging_events(spark, SF))).split("\n\n")[0]
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
