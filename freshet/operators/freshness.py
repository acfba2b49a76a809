"""Incident 03 and the dashboard summary: freshness, staleness, overall health.

All checks are one-row aggregates over a single scan. ``asof`` replaces
``CURRENT_TIMESTAMP()`` so results are repeatable; ``None`` means now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions import (asof_or_now, format_ts, freshness_hours_expr, hours_crossed,
                               minutes_crossed, ntz, since)
from freshet.operators.joins import attach_scalars

# Fixed value: the dashboard's freshness SLA in hours.
FRESHNESS_THRESHOLD_HOURS = 24


def latest_timestamps(events: DataFrame) -> DataFrame:
    """Latest load and latest event time."""
    return events.agg(F.max("loaded_at").alias("latest_load"),
                      F.max("event_timestamp").alias("latest_event"))


def layer_freshness(events: DataFrame, curated: DataFrame) -> DataFrame:
    """Latest curated date vs latest staging date, and where the lag is."""
    st = events.agg(F.max(F.to_date("event_timestamp")).alias("latest_staging_date"))
    cu = curated.agg(F.max("event_date").alias("latest_curated_date"))
    s, c = F.col("latest_staging_date"), F.col("latest_curated_date")
    verdict = (F.when(s.isNull(), F.lit("NO_STAGING_DATA"))
                .when(c.isNull() | (c < s), F.lit("TRANSFORMATION_BEHIND"))
                .otherwise(F.lit("IN_SYNC")))
    return attach_scalars(cu, st).select(c, s, verdict.alias("lag_layer"))


def hours_since_last_load(events: DataFrame, asof=None) -> DataFrame:
    """K1: latest load and ``DATEDIFF('hour', latest, asof)`` (hour boundaries crossed)."""
    return (events.agg(F.max("loaded_at").alias("latest_load"))
                  .select("latest_load",
                          hours_crossed("latest_load", asof_or_now(asof)).alias("hours_since_last_load")))


def minutes_since_last_load(events: DataFrame, asof=None) -> DataFrame:
    """K2: latest load and ``DATEDIFF('minute', latest, asof)``."""
    return (events.agg(F.max("loaded_at").alias("latest_load"))
                  .select("latest_load",
                          minutes_crossed("latest_load", asof_or_now(asof)).alias("minutes_since_last_load")))


def pipeline_health(events: DataFrame, asof=None, hours: int = 24) -> DataFrame:
    """K3: STALE when ``MAX(loaded_at) < asof - hours`` (strict); empty input is HEALTHY.

    An empty table gives a NULL maximum; the comparison is UNKNOWN and falls
    to ELSE, exactly as the SQL check does (the dashboard differs, see K5).
    """
    latest = F.max("loaded_at")
    return events.agg(F.when(latest < since(asof, hours, "hour"), F.lit("STALE"))
                       .otherwise(F.lit("HEALTHY")).alias("pipeline_health"))


def _freshness_columns(latest, asof, threshold_hours):
    hours = freshness_hours_expr(latest, asof)
    status = (F.when(hours.isNull(), F.lit("UNKNOWN"))
               .when(hours > F.lit(threshold_hours), F.lit("STALE"))
               .otherwise(F.lit("WITHIN_SLA")))
    return hours, status


def freshness_hours(events: DataFrame, asof=None, threshold_hours: float = FRESHNESS_THRESHOLD_HOURS) -> DataFrame:
    """K4: dashboard freshness -- elapsed hours (one decimal) and the SLA verdict."""
    agg = events.agg(F.max("loaded_at").alias("latest_load"))
    hours, status = _freshness_columns(F.col("latest_load"), asof, threshold_hours)
    return agg.select("latest_load", format_ts("latest_load").alias("latest_load_text"),
                      hours.alias("freshness_hours"), status.alias("freshness_status"))


def summary_metrics(events: DataFrame, curated: DataFrame, key: str = "event_id") -> DataFrame:
    """The five-metric summary row, one pass over staging.

    Staging is grouped by event id once (partial aggregation first); row
    count, NULL-provider count, duplicated ids and latest load all come from
    that one aggregate. Empty input yields zeros, not NULLs.
    """
    per_key = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("provider_id").isNull()).alias("_nulls"),
        F.max("loaded_at").alias("_latest"))
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("staging_rows"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).cast("bigint").alias("null_provider_ids"),
        F.count_if(F.col("_n") > 1).alias("duplicate_event_ids"),
        F.max("_latest").alias("latest_load"))
    cur = curated.agg(F.count(F.lit(1)).alias("curated_rows"))
    return attach_scalars(totals, cur).select("staging_rows", "curated_rows", "null_provider_ids",
                                              "duplicate_event_ids", "latest_load")


def health_status(summary: DataFrame, asof=None, threshold_hours: float = FRESHNESS_THRESHOLD_HOURS) -> DataFrame:
    """K5: overall status, first rule wins.

    No load -> CRITICAL; rounded freshness above the SLA -> CRITICAL;
    duplicated ids or NULL providers -> WARNING; else HEALTHY.
    """
    hours, _ = _freshness_columns(F.col("latest_load"), asof, threshold_hours)
    s = summary.withColumn("freshness_hours", hours)
    status = (F.when(F.col("latest_load").isNull(), F.lit("CRITICAL"))
               .when(F.col("freshness_hours") > F.lit(threshold_hours), F.lit("CRITICAL"))
               .when((F.col("duplicate_event_ids") > 0) | (F.col("null_provider_ids") > 0), F.lit("WARNING"))
               .otherwise(F.lit("HEALTHY")))
    return s.withColumn("health_status", status)


def load_history(audit: DataFrame, table_name: str, since_ts) -> DataFrame:
    """Load-audit rows of one table since a start time, newest first."""
    return (audit.filter((F.col("table_name") == F.lit(table_name)) & (F.col("last_load_time") >= ntz(since_ts)))
                 .orderBy(F.desc_nulls_last("last_load_time"), F.asc_nulls_last("file_name")))
