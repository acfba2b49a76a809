"""Registered queries of the maintained tables: each runs the job over several deliveries and returns the stored result.

The deliveries are parts of the given tables in load order, with late, tied and repeated rows among
them; the oracles state what a full computation over all rows gives. Tables go to new folders of the shared scratch
space (``sinks.scratch_path``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions import ntz
from freshet.operators import controls, duplicates, exclusion, quarantine, usage
from freshet.plans.queries import ANOMALY_FACTOR, ORACLE, USAGE_ASOF, register
from freshet.sources import schemas, sinks
from freshet.sources import tables as T
from freshet.streaming import batches, keystate, marks, refresh

PIPELINE = T.CONTROL_PIPELINE
OVERLAP_HOURS = 6
LATE_LOAD = "2024-02-05 00:00:00"  # when the late rows of the refresh arrive, after every other load
LATE_DAYS = ("2024-01-10", "2024-01-17")

# --------------------------------------------------------------- D1 + A5: incremental refresh of the curated table

_LATE = f"event_id % 5 = 0 AND CAST(event_timestamp AS DATE) IN (DATE '{LATE_DAYS[0]}', DATE '{LATE_DAYS[1]}')"


def _staging_with_late(spark, d):
    """(on time, late): every fifth event of two days arrives weeks later."""
    staging = T.staging_events(spark, d)
    late = F.coalesce(F.expr(_LATE), F.lit(False))
    return staging.filter(~late), staging.filter(late).withColumn("loaded_at", ntz(LATE_LOAD))


# recomputed: the late rows' days, and that of the row the first run ended with (the slice starts at its load time)
@register("refreshed_curated", f"""
WITH t AS (SELECT *, CAST(event_timestamp AS DATE) AS day, {_LATE} AS late FROM staging_events)
SELECT event_date, event_type, status, event_count,
       event_date IN (SELECT day FROM t WHERE late OR loaded_at = (SELECT MAX(loaded_at) FROM t WHERE NOT late)) AS recomputed
FROM curated_daily_events""", ("staging_events", "curated_daily_events"))
def q_refreshed_curated(spark, d):
    """The curated table after a first build and a refresh of the late rows' days."""
    on_time, late = _staging_with_late(spark, d)
    staging, curated, control = (sinks.scratch_path(spark, n) for n in ("staging", "curated", "control"))
    sinks.write_date_partitioned(on_time, staging, "event_timestamp", "event_date")
    refresh.refresh_curated(spark, spark.read.parquet(staging), curated, control, source_date_col="event_date")
    late.withColumn("event_date", F.to_date("event_timestamp")).write.mode("append").partitionBy("event_date").parquet(staging)
    run = refresh.refresh_curated(spark, spark.read.parquet(staging), curated, control, source_date_col="event_date")
    out = refresh.read_curated(spark, curated)
    return out.withColumn("recomputed", F.coalesce(F.col("event_date").isin(run["days"] or []), F.lit(False)))


# --------------------------------------------------------------- K13/K14: composite high-water mark

_T = f"TIMESTAMP '{T.TARGET_CUTOFF}'"
_SPAN = f"{_T} - INTERVAL '{OVERLAP_HOURS}' HOUR"
_TIED_CTES = f"""
tied AS (SELECT event_id, provider_id, event_type, status, CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS event_timestamp, loaded_at
         FROM staging_events),
loaded AS (SELECT * FROM tied WHERE (event_timestamp < {_T} OR (event_timestamp = {_T} AND event_id % 2 = 0))
             AND NOT (event_id % 3 = 0 AND event_timestamp >= {_SPAN}))"""


def _tied(spark, d):
    """Events with their timestamps cut to the hour, so that every timestamp is shared by many."""
    return T.staging_events(spark, d).withColumn("event_timestamp", F.date_trunc("hour", "event_timestamp").cast("timestamp_ntz"))


def _loaded(tied):
    """What was there at the last run: not the odd ids at the cut-off itself, nor every third event of the hours before."""
    ts, cut = F.col("event_timestamp"), ntz(T.TARGET_CUTOFF)
    there = (ts < cut) | ((ts == cut) & (F.col("event_id") % 2 == 0))
    return tied.filter(there & ~((F.col("event_id") % 3 == 0) & (ts >= cut - F.expr(f"INTERVAL {OVERLAP_HOURS} HOURS"))))


def _first_control(spark, target):
    return marks.advance_mark(spark.createDataFrame([], schemas.PIPELINE_MARKS), PIPELINE, target)


@register("incremental_by_mark", f"""
WITH {_TIED_CTES.strip()}
SELECT * FROM tied WHERE event_timestamp >= (SELECT MAX(event_timestamp) FROM loaded) - INTERVAL '{OVERLAP_HOURS}' HOUR
  AND NOT EXISTS (SELECT 1 FROM loaded l WHERE l.event_id = tied.event_id)""", ("staging_events",))
def q_incremental_by_mark(spark, d):
    tied = _tied(spark, d)
    target = _loaded(tied)
    mark = marks.read_mark(_first_control(spark, target), PIPELINE)
    return marks.incremental_by_mark(tied, target, mark, OVERLAP_HOURS * 3600)


@register("advance_mark", f"""
WITH {_TIED_CTES.strip()},
t AS (SELECT MAX(event_timestamp) AS m FROM tied)
SELECT '{PIPELINE}' AS pipeline_name, m AS last_successful_timestamp,
       (SELECT MAX(event_id) FROM tied WHERE event_timestamp = m) AS last_successful_key FROM t""", ("staging_events",))
def q_advance_mark(spark, d):
    tied = _tied(spark, d)
    control = _first_control(spark, _loaded(tied))
    return marks.advance_mark(control, PIPELINE, tied)


@register("loaded_by_mark", f"WITH {_TIED_CTES.strip()} SELECT * FROM tied", ("staging_events",))
def q_loaded_by_mark(spark, d):
    """Two runs, the second over tied and late rows and run again as after a crash before its mark was stored."""
    tied = _tied(spark, d)
    target, control = sinks.scratch_path(spark, "target"), sinks.scratch_path(spark, "marks")
    marks.load_by_mark(spark, _loaded(tied), target, control, PIPELINE, OVERLAP_HOURS * 3600)
    old = sinks.scratch_path(spark, "marks")
    sinks.read_control(spark, control, schemas.PIPELINE_MARKS).write.parquet(old)
    marks.load_by_mark(spark, tied, target, control, PIPELINE, OVERLAP_HOURS * 3600)
    marks.load_by_mark(spark, tied, target, old, PIPELINE, OVERLAP_HOURS * 3600)
    return spark.read.parquet(target).select(*tied.columns)


# --------------------------------------------------------------- Z1/Z3: batch-keyed loading, audit written with the load

_PERIOD = "concat('loads_', CAST((EXTRACT(DAY FROM loaded_at) - 1) // 10 AS INTEGER))"


def _periods(spark, d):
    """(rows with their delivery, delivery names): the doubled loads by ten days of the month."""
    rows = T.staging_events_dup(spark, d)
    name = F.concat(F.lit("loads_"), F.floor((F.dayofmonth("loaded_at") - 1) / 10).cast("string"))
    return rows.withColumn("_delivery", name), [f"loads_{k}" for k in range(4)]


def _delivered(spark, d):
    rows, names = _periods(spark, d)
    target, audit = sinks.scratch_path(spark, "batches"), sinks.scratch_path(spark, "audit")
    schema = rows.drop("_delivery").schema
    for name in names:
        batches.load_batch(spark, rows.filter(F.col("_delivery") == name).drop("_delivery"), target, audit, name)
    # the second batch is delivered again: first in part, then in full; the third one is skipped as loaded
    again = rows.filter(F.col("_delivery") == names[1]).drop("_delivery")
    batches.load_batch(spark, again.filter("event_id % 2 = 0"), target, audit, names[1])
    batches.load_batch(spark, again, target, audit, names[1])
    batches.load_batch(spark, rows.drop("_delivery"), target, audit, names[2], skip_loaded=True)
    return batches.read_loaded(spark, target, audit, schema), batches.read_audit(spark, audit)


_DELIVERED_CTE = f"""
delivered AS (
  SELECT *, {_PERIOD} AS load_batch FROM staging_events_dup
  QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id, {_PERIOD}
    ORDER BY loaded_at NULLS LAST, provider_id NULLS LAST, event_type NULLS LAST, status NULLS LAST, event_timestamp NULLS LAST) = 1)"""


@register("batch_keyed_load", f"WITH {_DELIVERED_CTE.strip()} SELECT * FROM delivered", ("staging_events_dup",))
def q_batch_keyed_load(spark, d):
    return _delivered(spark, d)[0]


@register("observed_load_audit", f"""
WITH {_DELIVERED_CTE.strip()}, k AS (SELECT unnest(range(4)) AS n)
SELECT 'STAGING_EVENTS' AS table_name, COUNT(event_id) AS row_count, MIN(loaded_at) AS first_load_time, MAX(loaded_at) AS last_load_time,
       concat('loads_', CAST(n AS VARCHAR)) AS file_name
FROM k LEFT JOIN delivered ON load_batch = concat('loads_', CAST(n AS VARCHAR)) GROUP BY n""", ("staging_events_dup",))
def q_observed_load_audit(spark, d):
    return _delivered(spark, d)[1]


# --------------------------------------------------------------- D3-D5/E1: maintained key counts

def _key_state(spark, d, compact_after: int = 2):
    rows, names = _periods(spark, d)
    path = sinks.scratch_path(spark, "keys")
    schema = keystate.state_schema(rows.schema)
    for k, name in enumerate(names):
        keystate.add_slice(spark, rows.filter(F.col("_delivery") == name), path, name)
        if k + 1 == compact_after:
            keystate.compact(spark, path, schema)
    return keystate.read_state(spark, path, schema)


@register("maintained_duplicate_details", ORACLE["duplicate_details"])
def q_maintained_duplicate_details(spark, d):
    return keystate.duplicate_details(_key_state(spark, d))


@register("maintained_duplication_extent", ORACLE["duplication_extent"])
def q_maintained_duplication_extent(spark, d):
    return keystate.duplication_extent(_key_state(spark, d))


# --------------------------------------------------------------- D3/E1/C9 on bucketed storage

BUCKETS = 8


def _bucketed(spark, df, key):
    path = sinks.scratch_path(spark, "bucketed")
    name = "bucketed_" + path.rsplit("-", 1)[1]
    return spark.table(sinks.write_bucketed(df, name, key, BUCKETS, path))


@register("bucketed_dedup", ORACLE["dedup_keep_first"])
def q_bucketed_dedup(spark, d):
    return duplicates.dedup_keep_first(_bucketed(spark, T.staging_events_dup(spark, d), "event_id"))


@register("bucketed_key_occurrences", ORACLE["key_occurrences"])
def q_bucketed_key_occurrences(spark, d):
    return duplicates.key_occurrences(_bucketed(spark, T.staging_events_dup(spark, d), "event_id"))


@register("bucketed_missing_keys", ORACLE["providers_without_events"])
def q_bucketed_missing_keys(spark, d):
    dim = _bucketed(spark, T.dim_provider_lookup(spark, d), "provider_id")
    return exclusion.missing_keys(dim, _bucketed(spark, T.staging_events(spark, d), "provider_id"), bucketed=True)


# --------------------------------------------------------------- Z4: quarantine

@register("quarantined_rows", """
WITH judged AS (
  SELECT e.*, list_filter([
      CASE WHEN event_id IS NULL THEN 'not_null:event_id' END,
      CASE WHEN provider_id IS NULL THEN 'not_null:provider_id' END,
      CASE WHEN status NOT IN ('APPROVED', 'COMPLETE') THEN 'accepted_values:status' END,
      CASE WHEN provider_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_provider_lookup p WHERE p.provider_id = e.provider_id)
           THEN 'relationship:provider_id' END,
      CASE WHEN event_id IS NOT NULL AND ROW_NUMBER() OVER (
             PARTITION BY event_id ORDER BY loaded_at NULLS LAST, provider_id NULLS LAST, event_type NULLS LAST, status NULLS LAST,
                                            event_timestamp NULLS LAST) > 1 THEN 'unique:event_id' END],
    lambda r: r IS NOT NULL) AS r
  FROM staging_events_dup e)
SELECT event_id, provider_id, event_type, status, event_timestamp, loaded_at, array_to_string(r, ',') AS reasons
FROM judged WHERE len(r) > 0""", ("staging_events_dup", "dim_provider_lookup"))
def q_quarantined_rows(spark, d):
    """The rejected rows as stored beside the accepted ones."""
    events = T.staging_events_dup(spark, d)
    judged = quarantine.with_reasons(events, T.dim_provider_lookup(spark, d), accepted=("APPROVED", "COMPLETE"))
    path = quarantine.write_quarantine(judged, sinks.scratch_path(spark, "quarantine"))
    rejected = quarantine.read_quarantine(spark, path, events.schema, quarantine.REJECTED)
    return rejected.withColumn("reasons", F.array_join("reasons", ","))


# --------------------------------------------------------------- Z5: missing spans

@register("missing_load_spans", f"""
WITH audits AS (
  SELECT table_name, CAST(last_load_time AS DATE) AS d FROM load_audit
  UNION ALL SELECT 'WEEKLY', CAST(loaded_at AS DATE) FROM staging_events WHERE EXTRACT(DAY FROM loaded_at) % 7 = 0),
days AS (SELECT DISTINCT table_name, d FROM audits WHERE d <= CAST(TIMESTAMP '{LATE_LOAD}' AS DATE)),
n AS (SELECT table_name, d, LEAD(d) OVER (PARTITION BY table_name ORDER BY d) AS nx FROM days),
s AS (SELECT table_name, d, coalesce(nx, CAST(TIMESTAMP '{LATE_LOAD}' AS DATE) + 1) AS nx, nx IS NULL AS is_open FROM n)
SELECT table_name, d + 1 AS first_missing, nx - 1 AS last_missing, CAST(nx - d - 1 AS INTEGER) AS missing_days, is_open FROM s WHERE nx - d > 1""",
          ("staging_events", "load_audit"))
def q_missing_load_spans(spark, d):
    weekly = T.staging_events(spark, d).filter(F.dayofmonth("loaded_at") % 7 == 0).select(F.lit("WEEKLY").alias("table_name"), F.col("loaded_at").alias("last_load_time"))
    audit = T.load_audit(spark, d).select("table_name", "last_load_time").unionByName(weekly)
    return controls.missing_load_spans(audit, LATE_LOAD)


# --------------------------------------------------------------- D16/D17/Z9/Z10: stored daily rollups

def _usage_rollup(spark, d):
    """The metering log's daily rollup after a first build and a refresh for rows that were metered late."""
    log = T.warehouse_metering_history(spark, d).withColumn("loaded_at", F.col("start_time") + F.expr("INTERVAL 5 MINUTES"))
    late = F.dayofmonth("start_time").isin(9, 10) & (F.col("warehouse_name") == "WH_1")
    staged, rollup, control = (sinks.scratch_path(spark, n) for n in ("metering", "usage", "control"))
    sinks.write_date_partitioned(log.filter(~late), staged, "start_time", "usage_date")
    refresh.refresh_usage(spark, spark.read.parquet(staged), rollup, control, source_date_col="usage_date")
    rest = log.filter(late).withColumn("loaded_at", ntz(LATE_LOAD)).withColumn("usage_date", F.to_date("start_time"))
    rest.write.mode("append").partitionBy("usage_date").parquet(staged)
    refresh.refresh_usage(spark, spark.read.parquet(staged), rollup, control, source_date_col="usage_date")
    return refresh.read_usage(spark, rollup)


@register("rollup_usage_anomalies", ORACLE["usage_anomalies"])
def q_rollup_usage_anomalies(spark, d):
    return controls.usage_anomalies(_usage_rollup(spark, d), ANOMALY_FACTOR)


@register("rollup_quota_status", ORACLE["credit_quota_status"])
def q_rollup_quota_status(spark, d):
    return controls.credit_quota_status(_usage_rollup(spark, d))


@register("rollup_usage_daily", ORACLE["warehouse_usage_daily"])
def q_rollup_usage_daily(spark, d):
    return usage.warehouse_usage_daily(_usage_rollup(spark, d), USAGE_ASOF)
