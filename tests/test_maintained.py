"""Maintained tables: crashes at every step, ties and late rows, and plans that read only what changed."""

from __future__ import annotations

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from freshet.operators import baseline, controls, duplicates, quarantine
from freshet.sources import schemas, seeds, sinks
from freshet.sources import tables as T
from freshet.streaming import batches, incremental, keystate, marks, refresh
from tests.helpers import plan_text, rows

SF = "/root/testdata/sf0.001"


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(path + "/**/*.parquet", recursive=True)}


# ------------------------------------------------------------------ sinks that survive a crash

@pytest.mark.parametrize("died", ["staging", "first partition", "marker"])
def test_partition_replace_is_finished_after_a_crash(spark, scratch, monkeypatch, died):
    path = os.path.join(scratch, "t")
    dated = seeds.seed_events(spark).withColumn("event_date", F.to_date("event_timestamp"))
    sinks.replace_table(dated, path, partition_by=["event_date"])
    before = sorted(rows(spark.read.parquet(path)), key=str)
    new = dated.withColumn("status", F.lit("NEW"))
    write = sinks.overwrite_partitions
    if died == "staging":
        monkeypatch.setattr(sinks, "write_text", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    else:
        def half(df, p, by):
            if died == "marker":
                write(df, p, by)
            else:  # one partition is new, one is gone, the others are old
                days = [r[0] for r in df.select("event_date").distinct().orderBy("event_date").collect()]
                write(df.filter(F.col("event_date") == days[0]), p, by)
                sinks.drop_partition(spark, p, "event_date", str(days[1]))
            raise KeyboardInterrupt
        monkeypatch.setattr(sinks, "overwrite_partitions", half)
    with pytest.raises(KeyboardInterrupt):
        sinks.replace_partitions(new, path, "event_date")
    monkeypatch.undo()
    applied = sinks.finish_partitions(spark, path)
    got = sorted(rows(spark.read.parquet(path)), key=str)
    if died == "staging":
        assert applied == 0 and got == before
    else:
        assert applied == 1 and len(got) == 10 and {r[3] for r in got} == {"NEW"}
    assert not glob.glob(path + ".__*") and sinks.finish_partitions(spark, path) == 0


def test_the_next_replace_finishes_the_one_that_died(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    dated = seeds.seed_events(spark).withColumn("event_date", F.to_date("event_timestamp"))
    sinks.replace_table(dated, path, partition_by=["event_date"])
    monkeypatch.setattr(sinks, "overwrite_partitions", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        sinks.replace_partitions(dated.withColumn("status", F.lit("FIRST")), path, "event_date")
    monkeypatch.undo()
    last = dated.agg(F.max("event_date")).first()[0]
    sinks.replace_partitions(dated.filter(F.col("event_date") == last).withColumn("status", F.lit("SECOND")), path, "event_date")
    got = {r["status"]: r["count"] for r in spark.read.parquet(path).groupBy("status").count().collect()}
    assert set(got) == {"FIRST", "SECOND"} and sum(got.values()) == 10


def test_no_mark_is_lost_when_the_control_swap_dies(spark, scratch, monkeypatch):
    src = seeds.seed_events(spark)
    target, control = os.path.join(scratch, "target"), os.path.join(scratch, "control")
    incremental.load_increment(spark, src.filter("event_id <= 5"), target, control, "OTHER")
    incremental.load_increment(spark, src.filter("event_id <= 5"), os.path.join(scratch, "t2"), control, "EVENT_PIPELINE")
    marks_before = sorted(rows(sinks.read_control(spark, control)))
    os.rename(control, control + ".__old-dead")  # the driver died between the two renames
    sinks.ensure_control(spark, control)
    assert sorted(rows(sinks.read_control(spark, control))) == marks_before
    os.rename(control, control + ".__old-dead2")
    run = incremental.load_increment(spark, src, target, control, "OTHER")
    assert run["watermark_before"] == dict(marks_before)["OTHER"]
    assert dict(rows(sinks.read_control(spark, control)))["EVENT_PIPELINE"] == dict(marks_before)["EVENT_PIPELINE"]
    assert spark.read.parquet(target).count() == 10


# ------------------------------------------------------------------ refresh of touched days

def staged(spark, scratch, df):
    path = os.path.join(scratch, "staging")
    return sinks.write_date_partitioned(df, path, "event_timestamp", "event_date")


def late_rows(spark, n=3):
    ids = F.col("event_id") + 10**9
    late = T.staging_events(spark, SF).filter(F.to_date("event_timestamp") == "2024-01-12").limit(n).withColumn("event_id", ids)
    none = late.limit(1).withColumn("event_timestamp", F.lit(None).cast("timestamp_ntz"))
    return late.unionByName(none).withColumn("loaded_at", F.lit("2024-03-01").cast("timestamp_ntz"))


def test_refresh_equals_a_rebuild_and_touches_only_the_late_days(spark, scratch):
    path = staged(spark, scratch, T.staging_events(spark, SF))
    curated, control = os.path.join(scratch, "curated"), os.path.join(scratch, "control")
    first = refresh.refresh_curated(spark, spark.read.parquet(path), curated, control, source_date_col="event_date")
    assert first["days"] is None and first["watermark_before"] is None
    before = files(curated)
    late_rows(spark).withColumn("event_date", F.to_date("event_timestamp")).write.mode("append").partitionBy("event_date").parquet(path)
    run = refresh.refresh_curated(spark, spark.read.parquet(path), curated, control, source_date_col="event_date")
    last_day = first["watermark_after"].date()
    assert dt.date(2024, 1, 12) in run["days"] and None in run["days"] and set(run["days"]) <= {None, dt.date(2024, 1, 12), last_day}
    want = baseline.curated_daily_events(spark.read.parquet(path))
    assert sorted(rows(refresh.read_curated(spark, curated)), key=str) == sorted(rows(want), key=str)
    kept = {f for f, at in files(curated).items() if before.get(f) == at}
    changed = {re.search(r"event_date=([^/]+)", f).group(1) for f in set(before) - kept}
    assert changed <= {"2024-01-12", str(last_day)}
    again = refresh.refresh_curated(spark, spark.read.parquet(path), curated, control, source_date_col="event_date")
    assert again["watermark_before"] == again["watermark_after"] == dt.datetime(2024, 3, 1)
    assert sorted(rows(refresh.read_curated(spark, curated)), key=str) == sorted(rows(want), key=str)


def test_refresh_prunes_untouched_days(spark, scratch):
    path = staged(spark, scratch, T.staging_events(spark, SF))
    stored = spark.read.parquet(path)
    days = [dt.date(2024, 1, 12), dt.date(2024, 1, 20)]
    plan = plan_text(baseline.curated_daily_events(stored.filter(refresh.on_days(days, date_col="event_date"))))
    assert re.search(r"PartitionFilters: \[.*event_date#\d+ IN \(2024-01-12,2024-01-20\)", plan)
    ranged = plan_text(baseline.curated_daily_events(T.staging_events(spark, SF).filter(refresh.on_days(days))))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-12T00:00\), LessThan\(ts,2024-01-21T00:00\)", ranged)
    slice_ = plan_text(stored.filter(F.col("loaded_at") >= F.lit("2024-01-25").cast("timestamp_ntz")).select("event_timestamp", "loaded_at"))
    assert "GreaterThanOrEqual(loaded_at," in slice_


@pytest.mark.parametrize("died", ["replace", "mark"])
def test_refresh_is_run_again_after_a_crash(spark, scratch, monkeypatch, died):
    path = staged(spark, scratch, T.staging_events(spark, SF))
    curated, control = os.path.join(scratch, "curated"), os.path.join(scratch, "control")
    refresh.refresh_curated(spark, spark.read.parquet(path), curated, control)
    late_rows(spark).withColumn("event_date", F.to_date("event_timestamp")).write.mode("append").partitionBy("event_date").parquet(path)
    where = (sinks, "overwrite_partitions") if died == "replace" else (sinks, "replace_table")
    monkeypatch.setattr(*where, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        refresh.refresh_curated(spark, spark.read.parquet(path), curated, control)
    monkeypatch.undo()
    refresh.refresh_curated(spark, spark.read.parquet(path), curated, control)
    want = baseline.curated_daily_events(spark.read.parquet(path))
    assert sorted(rows(refresh.read_curated(spark, curated)), key=str) == sorted(rows(want), key=str)


def test_refresh_sees_loads_that_commit_out_of_order(spark, scratch):
    src = T.staging_events(spark, SF)
    curated, control = os.path.join(scratch, "curated"), os.path.join(scratch, "control")
    cut = F.col("loaded_at") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    slow = F.col("event_id") % 10 == 3  # loads that take up to an hour to commit: older load times than the mark
    hour = F.lit("2024-01-19 23:00:00").cast("timestamp_ntz")
    refresh.refresh_curated(spark, src.filter(cut & ~(slow & (F.col("loaded_at") >= hour))), curated, control)
    refresh.refresh_curated(spark, src, curated, control, overlap=3600)
    assert sorted(rows(refresh.read_curated(spark, curated)), key=str) == sorted(rows(baseline.curated_daily_events(src)), key=str)


def test_empty_source_then_rows(spark, scratch):
    src = seeds.seed_events(spark)
    curated, control = os.path.join(scratch, "curated"), os.path.join(scratch, "control")
    assert refresh.refresh_curated(spark, src.limit(0), curated, control) == {"watermark_before": None, "watermark_after": None, "days": None}
    assert refresh.read_curated(spark, curated).count() == 0
    refresh.refresh_curated(spark, src, curated, control)
    assert sorted(rows(refresh.read_curated(spark, curated)), key=str) == sorted(rows(baseline.curated_daily_events(src)), key=str)


# ------------------------------------------------------------------ composite marks

EVENT = "event_id long, provider_id long, event_type string, status string, event_timestamp timestamp_ntz, loaded_at timestamp_ntz"


def event(i, minute, note="a"):
    return i, None, note, None, None if minute is None else dt.datetime(2024, 1, 1, 12, minute), dt.datetime(2024, 1, 2)


def ids(df):
    return sorted((r["event_id"] is not None, r["event_id"] or 0, r["event_type"]) for r in df.collect())


def test_ties_and_late_rows_are_neither_lost_nor_read_twice(spark):
    held = [event(1, 0), event(5, 10), event(7, 10), event(None, 10, "known")]
    target = spark.createDataFrame(held, EVENT)
    mark = marks.read_mark(marks.advance_mark(spark.createDataFrame([], schemas.PIPELINE_MARKS), "P", target), "P")
    assert mark == marks.Mark(dt.datetime(2024, 1, 1, 12, 10), 7)
    new = [event(6, 10), event(8, 10), event(9, 11), event(None, 10, "new"), event(None, 11, "new"), event(2, 8)]
    beyond, undated = [event(3, 1)], [event(4, None)]
    source = spark.createDataFrame(held + new + beyond + undated, EVENT)
    assert ids(marks.incremental_by_mark(source, target, mark, overlap=300)) == ids(spark.createDataFrame(new, EVENT))
    # a mark that is a timestamp loses the ties, or reads the boundary again
    assert 6 not in [r[0] for r in source.filter(F.col("event_timestamp") > marks.ntz(mark.ts)).collect()]
    assert 7 in [r[0] for r in source.filter(F.col("event_timestamp") >= marks.ntz(mark.ts)).collect()]
    assert marks.incremental_by_mark(source, target, None).count() == len(held + new + beyond + undated)
    none = marks.Mark(dt.datetime(2024, 1, 1, 12, 10), None)
    assert {r[0] for r in source.filter(marks.after_mark(none)).collect()} == {5, 6, 7, 8, 9, None}


def test_mark_bounds_reach_both_scans(spark):
    source, mark = T.staging_events(spark, SF), marks.Mark(dt.datetime(2024, 1, 29, 12), 50)
    plan = plan_text(marks.incremental_by_mark(source, T.target_events(spark, SF), mark, 3600))
    pushed = re.findall(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-29T11:00\)", plan)
    assert len(pushed) == 2 and len(re.findall(r"(?m)^\(\d+\) Scan parquet", plan)) == 2


@pytest.mark.parametrize("died", ["rows", "mark"])
def test_load_by_mark_after_a_crash(spark, scratch, monkeypatch, died):
    target, control = os.path.join(scratch, "target"), os.path.join(scratch, "marks")
    first = [event(1, 0), event(2, 5), event(4, 5)]
    marks.load_by_mark(spark, spark.createDataFrame(first, EVENT), target, control, "P", 600)
    before = files(target)
    second = [*first, event(3, 5), event(5, 6), event(5, 6), event(0, 1)]
    source = spark.createDataFrame(second, EVENT)
    name = "overwrite_partitions" if died == "rows" else "replace_table"
    monkeypatch.setattr(sinks, name, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        marks.load_by_mark(spark, source, target, control, "P", 600)
    monkeypatch.undo()
    more = spark.createDataFrame([*second, event(6, 7)], EVENT)
    run = marks.load_by_mark(spark, more, target, control, "P", 600)
    assert run["mark_before"].key == 4 and run["mark_after"] == marks.Mark(dt.datetime(2024, 1, 1, 12, 7), 6)
    assert sorted(r[0] for r in spark.read.parquet(target).select("event_id").collect()) == [0, 1, 2, 3, 4, 5, 6]
    assert all(files(target).get(f) == at for f, at in before.items())  # other batches are not rewritten
    # only late rows: the mark stays and the batch is repeated with what came since
    for extra in ([event(7, 4)], [event(7, 4), event(8, 4)]):
        run = marks.load_by_mark(spark, spark.createDataFrame([*second, event(6, 7), *extra], EVENT), target, control, "P", 600)
        assert run["mark_before"] == run["mark_after"]
    assert sorted(r[0] for r in spark.read.parquet(target).select("event_id").collect()) == list(range(9))


def test_load_by_mark_of_nothing(spark, scratch):
    target, control = os.path.join(scratch, "target"), os.path.join(scratch, "marks")
    empty = spark.createDataFrame([], EVENT)
    assert marks.load_by_mark(spark, empty, target, control, "P") == {"mark_before": None, "mark_after": None, "batch": marks.FIRST_BATCH}
    run = marks.load_by_mark(spark, spark.createDataFrame([event(1, 0)], EVENT), target, control, "P")
    assert run["batch"] == marks.FIRST_BATCH and spark.read.parquet(target).count() == 1


# ------------------------------------------------------------------ batches and their audit

def test_a_failed_batch_is_loaded_again(spark, scratch, monkeypatch):
    target, audit = os.path.join(scratch, "target"), os.path.join(scratch, "audit")
    src = T.staging_events_dup(spark, SF)
    a, b = src.filter("event_id < 400"), src.filter("event_id >= 400")
    batches.load_batch(spark, a, target, audit, "a")
    real = sinks.overwrite_partitions

    def die(df, path, by):
        if path == audit:
            raise KeyboardInterrupt
        real(df.filter("event_id % 2 = 0"), path, by)  # a part of the rows, then no audit row
    monkeypatch.setattr(sinks, "overwrite_partitions", die)
    with pytest.raises(KeyboardInterrupt):
        batches.load_batch(spark, b, target, audit, "b")
    monkeypatch.undo()
    schema = src.schema
    assert {r[0] for r in batches.read_loaded(spark, target, audit, schema).select("load_batch").distinct().collect()} == {"a"}
    row = batches.load_batch(spark, b, target, audit, "b", skip_loaded=True)
    want = duplicates.dedup_keep_first(src)
    got = batches.read_loaded(spark, target, audit, schema)
    assert sorted(rows(got.drop("load_batch"))) == sorted(rows(want))
    z3 = controls.load_audit_report(got.filter("load_batch = 'b'").withColumn("loaded_at", F.col("loaded_at")))
    assert row["row_count"] == sum(r["row_count"] for r in z3.collect())
    assert (row["first_load_time"], row["last_load_time"]) == (min(r["first_load_time"] for r in z3.collect()), max(r["last_load_time"] for r in z3.collect()))
    assert batches.load_batch(spark, b, target, audit, "b", skip_loaded=True) is None
    batches.load_batch(spark, b.limit(0), target, audit, "b")  # delivered again, empty
    assert batches.read_loaded(spark, target, audit, schema).filter("load_batch = 'b'").isEmpty()
    assert dict(rows(batches.read_audit(spark, audit).select("file_name", "row_count")))["b"] == 0
    with pytest.raises(ValueError):
        batches.load_batch(spark, b, target, audit, "")


def test_batch_names_are_escaped_and_null_keys_kept(spark, scratch):
    target, audit = os.path.join(scratch, "target"), os.path.join(scratch, "audit")
    name = "s3://bucket/2024-01-13 load=1/ü%.json"
    src = spark.createDataFrame([event(None, 1), event(None, 1), event(2, 1), event(2, 1)], EVENT)
    for _ in range(2):
        batches.load_batch(spark, src, target, audit, name)
    assert batches.read_loaded(spark, target, audit, src.schema).filter(F.col("load_batch") == name).count() == 3
    assert batches.is_loaded(spark, audit, name) and not batches.is_loaded(spark, audit, "other")
    batches.load_batch(spark, src, target, audit, name, keep_duplicates=True)
    assert batches.read_loaded(spark, target, audit, src.schema).count() == 4
    batches.load_batch(spark, src.limit(0), target, audit, name)
    assert batches.read_loaded(spark, target, audit, src.schema).isEmpty()


def test_loading_a_batch_reads_no_target(spark, scratch, monkeypatch):
    target, audit = os.path.join(scratch, "target"), os.path.join(scratch, "audit")
    src = T.staging_events(spark, SF)
    batches.load_batch(spark, src, target, audit, "a")
    plans = []
    real = sinks.overwrite_partitions
    monkeypatch.setattr(sinks, "overwrite_partitions", lambda df, p, by: (plans.append(plan_text(df)), real(df, p, by)))
    batches.load_batch(spark, src.filter("event_id < 10"), target, audit, "b")
    assert len(re.findall(r"(?m)^\(\d+\) Scan parquet", plans[0])) == 1 and target not in plans[0] and "Join" not in plans[0]
    assert "CollectMetrics" in plans[0]


# ------------------------------------------------------------------ maintained key counts

def test_state_equals_the_full_queries_after_every_slice(spark, scratch):
    path = os.path.join(scratch, "keys")
    src = T.staging_events_dup(spark, SF).unionByName(spark.createDataFrame([event(None, 1), event(None, 2)], EVENT))
    schema, slices = keystate.state_schema(src.schema), []
    for k in range(4):
        part = src.filter(F.coalesce(F.col("event_id"), F.lit(1)) % 4 == k) if k < 3 else src.filter("event_id % 4 = 3").unionByName(src.filter("event_id = 1"))
        for _ in range(2):  # a slice that is run again counts once
            keystate.add_slice(spark, part, path, f"slice {k}")
        slices.append(part)
        if k == 1:
            assert keystate.compact(spark, path, schema) == 2
            with pytest.raises(keystate.AlreadyMerged):
                keystate.add_slice(spark, part, path, "slice 1")
        seen = slices[0]
        for s in slices[1:]:
            seen = seen.unionByName(s)
        state = keystate.read_state(spark, path, schema)
        assert sorted(rows(keystate.duplicate_keys(state)), key=str) == sorted(rows(duplicates.duplicate_keys(seen)), key=str)
        assert sorted(rows(keystate.duplicate_details(state)), key=str) == sorted(rows(duplicates.duplicate_details(seen)), key=str)
        assert rows(keystate.duplication_extent(state)) == rows(duplicates.duplication_extent(seen))
    assert keystate.compact(spark, path, schema) == 4 and keystate.merged_slices(spark, path) == {f"slice {k}" for k in range(4)}
    with pytest.raises(ValueError):
        keystate.add_slice(spark, src, path, keystate.MERGED)


def test_first_rows_by_slices_equal_one_dedup(spark):
    src = T.staging_events_dup(spark, SF)
    cut = F.col("loaded_at") < F.lit("2024-01-15").cast("timestamp_ntz")
    a, b = src.filter(cut), src.filter(~cut)
    both = duplicates.dedup_keep_first(a).unionByName(keystate.new_keys_only(b, keystate.key_state(a)))
    assert sorted(rows(both)) == sorted(rows(duplicates.dedup_keep_first(src)))


def test_the_state_reads_no_staging(spark, scratch):
    path = os.path.join(scratch, "keys")
    src = T.staging_events_dup(spark, SF)
    keystate.add_slice(spark, src, path, "all")
    plan = plan_text(keystate.duplication_extent(keystate.read_state(spark, path, keystate.state_schema(src.schema))))
    assert "events.parquet" not in plan and len(re.findall(r"(?m)^\(\d+\) Scan parquet", plan)) == 1


# ------------------------------------------------------------------ quarantine and missing spans

def test_quarantine_parts_add_up_and_scan_once(spark, scratch):
    events = T.staging_events_dup(spark, SF).unionByName(spark.createDataFrame([event(None, 1), event(None, 1)], EVENT))
    dim = T.dim_provider_lookup(spark, SF)
    judged = quarantine.with_reasons(events, dim)
    assert len(re.findall(r"(?m)^\(\d+\) Scan parquet.*\n(?:.*\n)*?.*events.parquet", plan_text(quarantine.with_reasons(T.staging_events_dup(spark, SF), dim)))) == 1
    path = quarantine.write_quarantine(judged, os.path.join(scratch, "q"))
    good = quarantine.read_quarantine(spark, path, events.schema, quarantine.ACCEPTED)
    bad = quarantine.read_quarantine(spark, path, events.schema, quarantine.REJECTED)
    assert good.columns == events.columns and sorted(rows(good.unionByName(bad.drop("reasons"))), key=str) == sorted(rows(events), key=str)
    report = {(r["rule"], r["column_name"]): r["violations"] for r in controls.contract_report(good, dim).collect()}
    assert set(report.values()) == {0}
    counts = dict(rows(quarantine.reason_counts(judged)))
    full = {(r["rule"], r["column_name"]): r["violations"] for r in controls.contract_report(events, dim).collect()}
    assert counts["not_null:event_id"] == full["not_null", "event_id"] == 2
    assert counts["not_null:provider_id"] == full["not_null", "provider_id"] and counts["relationship:provider_id"] == full["relationship", "provider_id"]
    assert counts["unique:event_id"] == rows(duplicates.duplication_extent(events.filter("event_id IS NOT NULL")))[0][2]
    assert "PartitionFilters: [isnotnull(verdict" in plan_text(bad)


def test_quarantine_of_nothing(spark):
    events = T.staging_events(spark, SF).limit(0)
    judged = quarantine.with_reasons(events, T.dim_provider_lookup(spark, SF))
    assert judged.count() == 0 and quarantine.accepted_rows(judged).columns == events.columns and quarantine.rejected_rows(judged).count() == 0


def test_missing_spans(spark):
    day = "2024-01-{:02d} 10:00:00".format
    audit = spark.createDataFrame([("a", day(1)), ("a", day(1)), ("a", day(2)), ("a", day(6)), ("b", day(9)), ("c", None), ("d", day(31)), (None, day(7)), (None, day(10))],
                                  "table_name string, t string").select("table_name", F.col("t").cast("timestamp_ntz").alias("last_load_time"))
    got = rows(controls.missing_load_spans(audit, "2024-01-10 00:00:00"))
    d = lambda n: dt.date(2024, 1, n)
    assert got == [("a", d(3), d(5), 3, False), ("a", d(7), d(10), 4, True), ("b", d(10), d(10), 1, True), (None, d(8), d(9), 2, False)]
    one = rows(controls.missing_load_days(audit.filter("table_name = 'a'")))
    assert [r[0] for r in one] == [d(3), d(4), d(5)]


def test_rollup_refresh_after_late_metering(spark, scratch):
    log = T.warehouse_metering_history(spark, SF).withColumn("loaded_at", F.col("start_time"))
    late = F.col("warehouse_name") == "WH_2"
    path, control = os.path.join(scratch, "usage"), os.path.join(scratch, "control")
    day = F.to_date("start_time") == "2024-01-15"
    refresh.refresh_usage(spark, log.filter(~(late & day)), path, control)
    before = files(path)
    refresh.refresh_usage(spark, log.withColumn("loaded_at", F.when(late & day, F.lit("2024-03-01").cast("timestamp_ntz")).otherwise(F.col("loaded_at"))), path, control)
    rolled, own = refresh.read_usage(spark, path), log.drop("loaded_at")
    for monitor in (controls.usage_anomalies, controls.credit_quota_status):
        assert rows(monitor(rolled)) == rows(monitor(own))
    assert len(set(before) - set(files(path))) <= 2 * max(1, len([f for f in before if "2024-01-15" in f]))


# ------------------------------------------------------------------ bucketed storage

def test_bucketed_tables_are_checked_without_a_shuffle(spark, scratch):
    from freshet.operators import exclusion
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src, dim = T.staging_events_dup(spark, SF), T.dim_provider_lookup(spark, SF)
        by_event = spark.table(sinks.write_bucketed(src, "b_events", "event_id", 4, os.path.join(scratch, "e")))
        by_provider = spark.table(sinks.write_bucketed(src, "b_providers", "provider_id", 4, os.path.join(scratch, "p")))
        lookup = spark.table(sinks.write_bucketed(dim, "b_lookup", "provider_id", 4, os.path.join(scratch, "d")))
        jobs = {
            "count": (duplicates.key_occurrences(by_event), duplicates.key_occurrences(src)),
            "dedup": (duplicates.dedup_keep_first(by_event), duplicates.dedup_keep_first(src)),
            "anti": (exclusion.missing_keys(lookup, by_provider, bucketed=True), exclusion.missing_keys(dim, src)),
        }
        for name, (ours, plain) in jobs.items():
            plan = plan_text(ours)
            assert "Exchange" not in plan and "Bucketed: true" in plan, name
            assert "Exchange" in plan_text(plain)
            assert sorted(rows(ours), key=str) == sorted(rows(plain), key=str)
        # a NULL key on the left is kept, with and without buckets
        none = dim.limit(1).withColumn("provider_id", F.lit(None).cast("long"))
        more = spark.table(sinks.write_bucketed(dim.unionByName(none), "b_lookup2", "provider_id", 4, os.path.join(scratch, "n")))
        assert None in [r[0] for r in exclusion.missing_keys(more, by_provider, bucketed=True).collect()]
        assert len(glob.glob(os.path.join(scratch, "e", "*.parquet"))) <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_plain_queries_stay_when_the_subpackage_cannot_be_imported(monkeypatch):
    import builtins

    import __spark_entry__ as entry
    real = builtins.__import__

    def broken(name, *args, **kwargs):
        if name.startswith("freshet.llm"):
            raise ModuleNotFoundError("no module named xxhash")
        return real(name, *args, **kwargs)
    monkeypatch.setattr(builtins, "__import__", broken)
    names = entry.queries()
    assert "curated_daily_events" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
    assert set(entry.oracle_sql()) == set(names)
