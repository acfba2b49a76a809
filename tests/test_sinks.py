"""Sinks and table lifecycle round trips (in a fresh scratch folder per test)."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from freshet.operators import duplicates
from freshet.sources import schemas, seeds, sinks
from freshet.streaming import incremental
from tests.helpers import rows


def test_replace_table_from_itself(spark, scratch):
    path = os.path.join(scratch, "staging")
    e20 = duplicates.replay_batch(seeds.seed_events(spark))
    sinks.write_full_refresh(e20, path)
    current = spark.read.parquet(path)
    sinks.replace_table(duplicates.dedup_keep_first(current), path)
    again = spark.read.parquet(path)
    assert again.count() == 10
    assert duplicates.duplicate_keys(again).count() == 0
    assert not glob.glob(path + ".__*")


def test_replace_map_only_plan_reading_itself(spark, scratch):
    # a map-only rewrite of the path being read would fail mid-job if written in place
    path = os.path.join(scratch, "t")
    sinks.write_full_refresh(seeds.seed_events(spark), path)
    sinks.replace_table(spark.read.parquet(path).filter("event_id > 5"), path)
    assert spark.read.parquet(path).count() == 5


def test_export_csv_has_header(spark, scratch):
    path = os.path.join(scratch, "csv")
    sinks.export_csv(seeds.seed_providers(spark), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["provider_id", "provider_name", "specialty"]
    assert back.count() == 5


def test_control_table_lifecycle(spark, scratch):
    path = os.path.join(scratch, "pipeline_control")
    sinks.ensure_control(spark, path)
    sinks.ensure_control(spark, path)  # idempotent
    control = sinks.read_control(spark, path)
    assert control.count() == 0
    src = seeds.seed_events(spark)
    # first run: no watermark yet -> everything
    batch = incremental.incremental_by_control(src, control, "EVENT_PIPELINE")
    assert batch.count() == 10
    sinks.replace_table(incremental.advance_watermark(control, "EVENT_PIPELINE", batch), path)
    control = sinks.read_control(spark, path)
    assert rows(control) == [("EVENT_PIPELINE", dt.datetime(2026, 7, 23, 16, 10))]
    # second run: nothing new, and the mark does not move
    batch2 = incremental.incremental_by_control(src, control, "EVENT_PIPELINE")
    assert batch2.count() == 0
    sinks.replace_table(incremental.advance_watermark(control, "EVENT_PIPELINE", batch2), path)
    assert rows(sinks.read_control(spark, path)) == [("EVENT_PIPELINE", dt.datetime(2026, 7, 23, 16, 10))]
    # inclusive bound rereads the boundary row
    inc = incremental.incremental_by_control(src, sinks.read_control(spark, path), "EVENT_PIPELINE", inclusive=True)
    assert inc.count() == 1


def test_append_default_load_ts(spark):
    base = seeds.seed_events(spark)
    new = spark.createDataFrame([(11, None, "AUTHORIZATION", "APPROVED", dt.datetime(2026, 7, 25))],
                                "event_id long, provider_id long, event_type string, status string, "
                                "event_timestamp timestamp_ntz")
    out = incremental.append_with_default_load_ts(base, new, "2026-07-25 01:00:00")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.STAGING_EVENTS]
    r = out.filter(F.col("event_id") == 11).collect()[0]
    assert r["loaded_at"] == dt.datetime(2026, 7, 25, 1, 0)
    assert out.count() == 11


def test_incremental_load_job_is_idempotent_across_a_failed_run(spark, scratch):
    src = seeds.seed_events(spark)
    target, control = os.path.join(scratch, "target"), os.path.join(scratch, "control")
    first_half = src.filter("event_timestamp < '2026-07-22 00:00:00'")
    r1 = incremental.load_increment(spark, first_half, target, control, "EVENT_PIPELINE")
    assert r1 == {"watermark_before": None, "watermark_after": dt.datetime(2026, 7, 21, 12, 0)}
    assert spark.read.parquet(target).count() == 5
    # a run that appends the next slice but dies before advancing the watermark ...
    batch = incremental.incremental_by_control(src, sinks.read_control(spark, control), "EVENT_PIPELINE")
    batch.filter("event_id <= 7").write.mode("append").parquet(target)
    # ... is simply rerun: nothing is appended twice, and the mark moves once
    r2 = incremental.load_increment(spark, src, target, control, "EVENT_PIPELINE")
    assert r2["watermark_after"] == dt.datetime(2026, 7, 23, 16, 10)
    stored = spark.read.parquet(target)
    assert stored.count() == 10 and duplicates.duplicate_keys(stored).count() == 0
    r3 = incremental.load_increment(spark, src, target, control, "EVENT_PIPELINE")
    assert r3["watermark_before"] == r3["watermark_after"] and spark.read.parquet(target).count() == 10


def test_load_increment_stores_one_row_per_key(spark, scratch):
    from freshet.sources import tables as T
    sf = "/root/testdata/sf0.001"
    target, control = os.path.join(scratch, "target"), os.path.join(scratch, "control")
    src = T.staging_events_dup(spark, sf)
    n = src.select("event_id").distinct().count()
    incremental.load_increment(spark, src, target, control, "EVENT_PIPELINE")
    assert src.count() > n == spark.read.parquet(target).count()
    # a run that stored its slice but died before moving the mark is rerun
    late = src.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL 60 DAYS")).withColumn("event_id", F.col("event_id") + 10**9)
    half = incremental.first_per_key(late.filter("event_id % 2 = 0"), "event_id", "loaded_at")
    half.write.mode("append").parquet(target)
    incremental.load_increment(spark, late, target, control, "EVENT_PIPELINE")
    stored = spark.read.parquet(target)
    assert stored.count() == 2 * n and duplicates.duplicate_keys(stored).count() == 0


def test_a_swap_that_died_is_undone(spark, scratch):
    path = os.path.join(scratch, "t")
    sinks.write_full_refresh(seeds.seed_events(spark), path)
    os.rename(path, path + ".__old-abc")  # the crash left no table
    assert sinks.recover_table(spark, path) and spark.read.parquet(path).count() == 10
    os.rename(path, path + ".__old-def")
    sinks.replace_table(seeds.seed_events(spark).filter("event_id > 5"), path)
    assert spark.read.parquet(path).count() == 5 and not glob.glob(path + ".__*")


def test_date_partitions_get_about_one_file_each(spark, scratch):
    from freshet.sources import tables as T
    path = sinks.write_date_partitioned(T.staging_events(spark, "/root/testdata/sf0.001").repartition(8),
                                        os.path.join(scratch, "dated"), "event_timestamp", "event_date")
    dates = glob.glob(path + "/event_date=*")
    assert len(glob.glob(path + "/event_date=*/*.parquet")) <= 2 * len(dates)


def test_merge_rewrites_only_the_batch_partitions(spark, scratch):
    from freshet.operators import controls
    dated = seeds.seed_events(spark).withColumn("event_date", F.to_date("event_timestamp"))
    path = os.path.join(scratch, "merged")
    dated.write.partitionBy("event_date").parquet(path)
    target = spark.read.parquet(path).select(*dated.columns)
    batch = dated.filter("event_id >= 8").withColumn("status", F.lit("NEW"))
    merged = controls.merge_upsert(target, batch.unionByName(batch), date_col="event_date")
    before = {f: os.path.getmtime(f) for f in glob.glob(path + "/event_date=*/*.parquet")}
    sinks.replace_partitions(merged, path, "event_date")
    again = spark.read.parquet(path)
    assert again.count() == 10 and again.filter("status = 'NEW'").count() == 3
    touched = {os.path.dirname(f) for f in before if not os.path.exists(f)}
    days = {f"{path}/event_date={r[0]}" for r in batch.select("event_date").distinct().collect()}
    assert touched and touched <= {d for d in {os.path.dirname(f) for f in before} if d >= min(days)}


@pytest.mark.parametrize("all_undated", [False, True])
def test_merge_keeps_target_rows_without_a_date(spark, scratch, all_undated):
    from freshet.operators import controls
    date = F.when(F.col("event_id") % 2 == 0, F.to_date("event_timestamp"))  # odd ids have no date
    dated = seeds.seed_events(spark).withColumn("event_date", date)
    path = os.path.join(scratch, "undated")
    dated.write.partitionBy("event_date").parquet(path)
    target = spark.read.parquet(path).select(*dated.columns)
    changed = dated.filter("event_id = 9" if all_undated else "event_id >= 8").withColumn("status", F.lit("NEW"))
    added = changed.filter("event_id = 9").withColumn("event_id", F.lit(99).cast(dated.schema["event_id"].dataType))
    merged = controls.merge_upsert(target, changed.unionByName(added), date_col="event_date")
    sinks.replace_partitions(merged, path, "event_date")
    got = {r["event_id"]: r["status"] for r in spark.read.parquet(path).collect()}
    assert got.keys() == {*range(1, 11), 99}
    assert {i for i, s in got.items() if s == "NEW"} == ({9, 99} if all_undated else {8, 9, 10, 99})


def test_declared_readers(spark, scratch):
    import pytest

    from freshet.sources import readers
    from freshet.sources import tables as T
    path = os.path.join(scratch, "log")
    T.warehouse_metering_history(spark, "/root/testdata/sf0.001").withColumn("extra", F.lit(1)).write.parquet(path)
    got = readers.read_metering(spark, path)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schemas.WAREHOUSE_METERING_HISTORY]
    with pytest.raises(readers.SchemaMismatch, match="query_id is missing"):
        readers.read_query_history(spark, path)
    T.warehouse_metering_history(spark, "/root/testdata/sf0.001").withColumn("credits_used", F.col("credits_used").cast("double")).write.parquet(path + "2")
    with pytest.raises(readers.SchemaMismatch, match="credits_used is double"):
        readers.read_metering(spark, path + "2")


def test_file_load_audit_from_landed_files(spark, scratch):
    from freshet.operators import controls, freshness
    from freshet.sources import tables
    path = os.path.join(scratch, "landing")
    ev = seeds.seed_events(spark)
    ev.filter("event_id <= 4").write.mode("append").parquet(path)
    ev.filter("event_id > 4").write.mode("append").parquet(path)
    audit = tables.file_load_audit(spark, path, "STAGING_EVENTS")
    assert [f.name for f in audit.schema] == [f.name for f in schemas.LOAD_AUDIT]
    got = audit.collect()
    assert sum(r["row_count"] for r in got) == 10 and all(r["file_name"].endswith(".parquet") for r in got)
    history = freshness.load_history(audit, "STAGING_EVENTS", "2000-01-01 00:00:00")
    assert history.count() == len(got)
    expected = spark.createDataFrame([(r["file_name"],) for r in got] + [("file:/missing.parquet",)], "file_name string")
    assert [r[0] for r in controls.missing_files(expected, audit).collect()] == ["file:/missing.parquet"]
