"""The registered queries: one per operator, each with its DuckDB oracle.

Every query reads the given test tables (or tables Spark derives from them
in ``freshet.sources.tables``) in full; parameters are the fixed ``asof``
values, warehouse and thresholds below. ``ORACLE`` holds, for each query,
ANSI SQL with the same column names that DuckDB runs on the raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import ntz
from freshet.operators import baseline, controls, duplicates, exclusion, explorer, freshness, keys, usage
from freshet.plans.views import with_views
from freshet.sources import readers, sinks
from freshet.sources import tables as T
from freshet.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered queries.
USAGE_ASOF = "2024-01-31 00:00:00"      # usage look-backs, just after the last event
FRESHNESS_ASOF = "2024-01-31 03:01:00"  # after the last load
HEALTH_6H_ASOF = "2024-01-31 09:00:00"  # STALE at 6 h, HEALTHY at 24 h
WINDOW_ASOF = "2024-01-31 00:30:00"     # last hour of loads is not empty
HISTORY_SINCE = "2024-01-29 00:00:00"   # two days back
WAREHOUSE = "WH_1"
PIPELINE = T.CONTROL_PIPELINE
EXPLORER_TYPES = ("click", "purchase", "view")
EXPLORER_STATUSES = ("APPROVED", "COMPLETE")
EXPLORER_LIMIT = 500


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *views)
        return fn
    return deco


def _staging(spark, d):
    return T.staging_events(spark, d)


def _curated(spark, d):
    return baseline.curated_daily_events(_staging(spark, d))


# --------------------------------------------------------------- baseline

@register("curated_daily_events", """
SELECT CAST(event_timestamp AS DATE) AS event_date, event_type, status, COUNT(*) AS event_count
FROM staging_events
GROUP BY CAST(event_timestamp AS DATE), event_type, status
ORDER BY event_date, event_type, status""", ("staging_events",))
def q_curated_daily_events(spark, d):
    return baseline.curated_ordered(_curated(spark, d))


@register("event_trend", """
SELECT event_date, CAST(SUM(event_count) AS BIGINT) AS total_events
FROM curated_daily_events GROUP BY event_date ORDER BY event_date""", ("curated_daily_events",))
def q_event_trend(spark, d):
    return baseline.event_trend(_curated(spark, d))


@register("status_distribution", """
SELECT status, CAST(SUM(event_count) AS BIGINT) AS event_count
FROM curated_daily_events GROUP BY status ORDER BY event_count DESC""", ("curated_daily_events",))
def q_status_distribution(spark, d):
    return baseline.status_distribution(_curated(spark, d))


@register("event_type_distribution", """
SELECT event_type, CAST(SUM(event_count) AS BIGINT) AS event_count
FROM curated_daily_events GROUP BY event_type ORDER BY event_count DESC""", ("curated_daily_events",))
def q_event_type_distribution(spark, d):
    return baseline.event_type_distribution(_curated(spark, d))


# --------------------------------------------------------------- duplicates

@register("staging_row_count", "SELECT COUNT(*) AS total_rows FROM staging_events_dup",
          ("staging_events_dup",))
def q_staging_row_count(spark, d):
    return duplicates.row_count(T.staging_events_dup(spark, d))


@register("duplicate_keys", """
SELECT event_id, COUNT(*) AS duplicate_count FROM staging_events_dup
GROUP BY event_id HAVING COUNT(*) > 1 ORDER BY event_id""", ("staging_events_dup",))
def q_duplicate_keys(spark, d):
    return duplicates.duplicate_keys(T.staging_events_dup(spark, d))


@register("duplicate_keys_lineitem", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS duplicate_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1 ORDER BY l_orderkey, l_linenumber""")
def q_duplicate_keys_lineitem(spark, d):
    return duplicates.duplicate_keys(T.lineitem(spark, d), ["l_orderkey", "l_linenumber"])


@register("duplicate_details", """
SELECT event_id, COUNT(*) AS duplicate_count, MIN(loaded_at) AS first_loaded_at,
       MAX(loaded_at) AS last_loaded_at
FROM staging_events_dup GROUP BY event_id HAVING COUNT(*) > 1
ORDER BY duplicate_count DESC, event_id""", ("staging_events_dup",))
def q_duplicate_details(spark, d):
    return duplicates.duplicate_details(T.staging_events_dup(spark, d))


@register("duplication_extent", """
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT event_id) AS unique_events,
       COUNT(*) - COUNT(DISTINCT event_id) AS duplicate_rows
FROM staging_events_dup""", ("staging_events_dup",))
def q_duplication_extent(spark, d):
    return duplicates.duplication_extent(T.staging_events_dup(spark, d))


@register("key_occurrences", """
SELECT event_id, COUNT(*) AS occurrence_count FROM staging_events_dup
GROUP BY event_id HAVING COUNT(*) >= 1""", ("staging_events_dup",))
def q_key_occurrences(spark, d):
    return duplicates.key_occurrences(T.staging_events_dup(spark, d))


@register("dedup_keep_first", """
SELECT event_id, provider_id, event_type, status, event_timestamp, loaded_at
FROM staging_events_dup
QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id
                           ORDER BY loaded_at NULLS LAST, provider_id NULLS LAST, event_type NULLS LAST,
                                    status NULLS LAST, event_timestamp NULLS LAST) = 1""",
          ("staging_events_dup",))
def q_dedup_keep_first(spark, d):
    return duplicates.dedup_keep_first(T.staging_events_dup(spark, d))


_LI_TIES = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus")


@register("dedup_keep_first_lineitem", f"""
SELECT * FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate NULLS LAST,
                                    {', '.join(c + ' NULLS LAST' for c in _LI_TIES)}) = 1""")
def q_dedup_keep_first_lineitem(spark, d):
    return duplicates.dedup_keep_first(T.lineitem(spark, d), ["l_orderkey", "l_linenumber"],
                                       order=["l_shipdate"], tie_breakers=list(_LI_TIES))


# --------------------------------------------------------------- NULLs and exclusion

@register("null_key_records", """
SELECT event_id, provider_id, event_type, status, event_timestamp, loaded_at
FROM staging_events WHERE provider_id IS NULL ORDER BY loaded_at DESC, event_id""", ("staging_events",))
def q_null_key_records(spark, d):
    return exclusion.null_key_records(_staging(spark, d))


@register("null_key_count", """
SELECT COUNT(*) AS null_provider_ids FROM staging_events WHERE provider_id IS NULL""", ("staging_events",))
def q_null_key_count(spark, d):
    return exclusion.null_key_count(_staging(spark, d))


@register("distinct_keys", """
SELECT DISTINCT provider_id FROM staging_events ORDER BY provider_id""", ("staging_events",))
def q_distinct_keys(spark, d):
    return exclusion.distinct_keys(_staging(spark, d))


@register("unmatched_providers", """
SELECT e.event_id, e.provider_id, e.event_type, e.status, e.event_timestamp
FROM staging_events AS e LEFT JOIN dim_provider_lookup AS p ON e.provider_id = p.provider_id
WHERE e.provider_id IS NOT NULL AND p.provider_id IS NULL
ORDER BY e.event_timestamp DESC""", ("staging_events", "dim_provider_lookup"))
def q_unmatched_providers(spark, d):
    return exclusion.unmatched_providers(_staging(spark, d), T.dim_provider_lookup(spark, d))


@register("providers_without_events", """
SELECT p.provider_id FROM dim_provider_lookup p
WHERE NOT EXISTS (SELECT 1 FROM staging_events e WHERE e.provider_id = p.provider_id)""",
          ("staging_events", "dim_provider_lookup"))
def q_providers_without_events(spark, d):
    return exclusion.missing_keys(T.dim_provider_lookup(spark, d), _staging(spark, d))


@register("events_without_provider", """
SELECT e.provider_id FROM staging_events e
WHERE NOT EXISTS (SELECT 1 FROM dim_provider_lookup p WHERE p.provider_id = e.provider_id)""",
          ("staging_events", "dim_provider_lookup"))
def q_events_without_provider(spark, d):
    return exclusion.orphan_events(_staging(spark, d), T.dim_provider_lookup(spark, d))


@register("not_in_exclusion", """
SELECT provider_id FROM dim_provider_lookup
WHERE provider_id NOT IN (SELECT provider_id FROM staging_events)""",
          ("staging_events", "dim_provider_lookup"))
def q_not_in_exclusion(spark, d):
    return exclusion.not_in_keys(T.dim_provider_lookup(spark, d), _staging(spark, d))


@register("not_in_non_null_exclusion", """
SELECT provider_id FROM dim_provider_lookup
WHERE provider_id NOT IN (SELECT provider_id FROM staging_events WHERE provider_id IS NOT NULL)""",
          ("staging_events", "dim_provider_lookup"))
def q_not_in_non_null_exclusion(spark, d):
    return exclusion.not_in_non_null(T.dim_provider_lookup(spark, d), _staging(spark, d))


@register("exclusion_comparison", """
SELECT (SELECT COUNT(*) FROM dim_provider_lookup
        WHERE provider_id NOT IN (SELECT provider_id FROM staging_events)) AS not_in_count,
       (SELECT COUNT(*) FROM dim_provider_lookup p
        WHERE NOT EXISTS (SELECT 1 FROM staging_events e WHERE e.provider_id = p.provider_id)) AS not_exists_count,
       (SELECT COUNT(*) FROM staging_events WHERE provider_id IS NULL) AS null_provider_ids""",
          ("staging_events", "dim_provider_lookup"))
def q_exclusion_comparison(spark, d):
    return exclusion.exclusion_comparison(T.dim_provider_lookup(spark, d), _staging(spark, d))


# --------------------------------------------------------------- freshness

@register("summary_metrics", """
SELECT (SELECT COUNT(*) FROM staging_events_dup) AS staging_rows,
       (SELECT COUNT(*) FROM curated_daily_events) AS curated_rows,
       (SELECT COUNT(*) FROM staging_events_dup WHERE provider_id IS NULL) AS null_provider_ids,
       (SELECT COUNT(*) FROM (SELECT event_id FROM staging_events_dup GROUP BY event_id
                              HAVING COUNT(*) > 1)) AS duplicate_event_ids,
       (SELECT MAX(loaded_at) FROM staging_events_dup) AS latest_load""",
          ("staging_events_dup", "curated_daily_events"))
def q_summary_metrics(spark, d):
    return freshness.summary_metrics(T.staging_events_dup(spark, d), _curated(spark, d))


_FRESH_SQL = f"""
CASE WHEN latest_load IS NULL THEN NULL
     ELSE round_even(epoch_us(TIMESTAMP '{FRESHNESS_ASOF}' - latest_load) / 3.6e9, 1) END"""


@register("health_status", f"""
WITH s AS (
  SELECT (SELECT COUNT(*) FROM staging_events_dup) AS staging_rows,
         (SELECT COUNT(*) FROM curated_daily_events) AS curated_rows,
         (SELECT COUNT(*) FROM staging_events_dup WHERE provider_id IS NULL) AS null_provider_ids,
         (SELECT COUNT(*) FROM (SELECT event_id FROM staging_events_dup GROUP BY event_id
                                HAVING COUNT(*) > 1)) AS duplicate_event_ids,
         (SELECT MAX(loaded_at) FROM staging_events_dup) AS latest_load),
f AS (SELECT *, {_FRESH_SQL} AS freshness_hours FROM s)
SELECT *, CASE WHEN latest_load IS NULL THEN 'CRITICAL'
               WHEN freshness_hours > 24 THEN 'CRITICAL'
               WHEN duplicate_event_ids > 0 OR null_provider_ids > 0 THEN 'WARNING'
               ELSE 'HEALTHY' END AS health_status
FROM f""", ("staging_events_dup", "curated_daily_events"))
def q_health_status(spark, d):
    summary = freshness.summary_metrics(T.staging_events_dup(spark, d), _curated(spark, d))
    return freshness.health_status(summary, FRESHNESS_ASOF)


@register("latest_timestamps", """
SELECT MAX(loaded_at) AS latest_load, MAX(event_timestamp) AS latest_event FROM staging_events""",
          ("staging_events",))
def q_latest_timestamps(spark, d):
    return freshness.latest_timestamps(_staging(spark, d))


@register("layer_freshness", """
WITH c AS (SELECT MAX(event_date) AS latest_curated_date FROM curated_daily_events),
     s AS (SELECT MAX(CAST(event_timestamp AS DATE)) AS latest_staging_date FROM staging_events)
SELECT latest_curated_date, latest_staging_date,
       CASE WHEN latest_staging_date IS NULL THEN 'NO_STAGING_DATA'
            WHEN latest_curated_date IS NULL OR latest_curated_date < latest_staging_date
                 THEN 'TRANSFORMATION_BEHIND'
            ELSE 'IN_SYNC' END AS lag_layer
FROM c CROSS JOIN s""", ("staging_events", "curated_daily_events"))
def q_layer_freshness(spark, d):
    return freshness.layer_freshness(_staging(spark, d), _curated(spark, d))


@register("hours_since_last_load", f"""
SELECT MAX(loaded_at) AS latest_load,
       date_diff('hour', MAX(loaded_at), TIMESTAMP '{FRESHNESS_ASOF}') AS hours_since_last_load
FROM staging_events""", ("staging_events",))
def q_hours_since_last_load(spark, d):
    return freshness.hours_since_last_load(_staging(spark, d), FRESHNESS_ASOF)


@register("minutes_since_last_load", f"""
SELECT MAX(loaded_at) AS latest_load,
       date_diff('minute', MAX(loaded_at), TIMESTAMP '{FRESHNESS_ASOF}') AS minutes_since_last_load
FROM staging_events""", ("staging_events",))
def q_minutes_since_last_load(spark, d):
    return freshness.minutes_since_last_load(_staging(spark, d), FRESHNESS_ASOF)


def _health_sql(asof: str, hours: int) -> str:
    return f"""
SELECT CASE WHEN MAX(loaded_at) < TIMESTAMP '{asof}' - INTERVAL '{hours}' HOUR THEN 'STALE'
            ELSE 'HEALTHY' END AS pipeline_health
FROM staging_events"""


@register("staleness_check", _health_sql(FRESHNESS_ASOF, 24), ("staging_events",))
def q_staleness_check(spark, d):
    return freshness.pipeline_health(_staging(spark, d), FRESHNESS_ASOF, 24)


@register("staleness_check_6h", _health_sql(HEALTH_6H_ASOF, 6), ("staging_events",))
def q_staleness_check_6h(spark, d):
    return freshness.pipeline_health(_staging(spark, d), HEALTH_6H_ASOF, 6)


@register("freshness_hours", f"""
WITH a AS (SELECT MAX(loaded_at) AS latest_load FROM staging_events),
f AS (SELECT latest_load, {_FRESH_SQL} AS freshness_hours FROM a)
SELECT latest_load,
       COALESCE(strftime(latest_load, '%Y-%m-%d %H:%M:%S'), 'No load found') AS latest_load_text,
       freshness_hours,
       CASE WHEN freshness_hours IS NULL THEN 'UNKNOWN' WHEN freshness_hours > 24 THEN 'STALE'
            ELSE 'WITHIN_SLA' END AS freshness_status
FROM f""", ("staging_events",))
def q_freshness_hours(spark, d):
    return freshness.freshness_hours(_staging(spark, d), FRESHNESS_ASOF)


@register("load_history", f"""
SELECT file_name, table_name, last_load_time, row_count FROM load_audit
WHERE table_name = 'STAGING_EVENTS' AND last_load_time >= TIMESTAMP '{HISTORY_SINCE}'
ORDER BY last_load_time DESC""", ("load_audit",))
def q_load_history(spark, d):
    return freshness.load_history(T.load_audit(spark, d), T.AUDIT_TABLE_NAME, HISTORY_SINCE)


# --------------------------------------------------------------- key types

@register("naive_type_join", """
SELECT e.event_id, e.provider_id, p.provider_name
FROM staging_events e JOIN provider_string_source p ON CAST(e.provider_id AS VARCHAR) = p.provider_id""",
          ("staging_events", "provider_string_source"))
def q_naive_type_join(spark, d):
    return keys.naive_type_join(_staging(spark, d), T.provider_string_source(spark, d))


@register("join_row_counts", """
SELECT (SELECT COUNT(*) FROM staging_events) AS staging_rows,
       (SELECT COUNT(*) FROM staging_events e JOIN provider_string_source p
          ON CAST(e.provider_id AS VARCHAR) = p.provider_id) AS joined_rows""",
          ("staging_events", "provider_string_source"))
def q_join_row_counts(spark, d):
    return keys.join_row_counts(_staging(spark, d), T.provider_string_source(spark, d))


@register("naive_unmatched", """
SELECT e.event_id, e.provider_id, p.provider_id AS lookup_provider_id, p.provider_name
FROM staging_events e LEFT JOIN provider_string_source p ON CAST(e.provider_id AS VARCHAR) = p.provider_id
WHERE p.provider_id IS NULL""", ("staging_events", "provider_string_source"))
def q_naive_unmatched(spark, d):
    return keys.naive_unmatched(_staging(spark, d), T.provider_string_source(spark, d))


@register("safe_join_no_trim", """
SELECT e.event_id, e.provider_id, p.provider_name
FROM staging_events e LEFT JOIN provider_string_source p
  ON e.provider_id = TRY_CAST(TRY_CAST(p.provider_id AS DECIMAL(38,0)) AS BIGINT)""",
          ("staging_events", "provider_string_source"))
def q_safe_join_no_trim(spark, d):
    return keys.safe_join(_staging(spark, d), T.provider_string_source(spark, d), trim=False)


@register("safe_join", """
SELECT e.event_id, e.provider_id, p.provider_name
FROM staging_events e LEFT JOIN provider_string_source p
  ON e.provider_id = TRY_CAST(TRY_CAST(TRIM(p.provider_id) AS DECIMAL(38,0)) AS BIGINT)""",
          ("staging_events", "provider_string_source"))
def q_safe_join(spark, d):
    return keys.safe_join(_staging(spark, d), T.provider_string_source(spark, d))


@register("stg_provider", "SELECT provider_id, provider_name FROM stg_provider", ("stg_provider",))
def q_stg_provider(spark, d):
    return keys.stg_provider(T.provider_string_source(spark, d))


@register("stg_provider_join", """
SELECT e.event_id, e.provider_id, p.provider_name
FROM staging_events e LEFT JOIN stg_provider p ON e.provider_id = p.provider_id""",
          ("staging_events", "stg_provider"))
def q_stg_provider_join(spark, d):
    return keys.stg_provider_join(_staging(spark, d), keys.stg_provider(T.provider_string_source(spark, d)))


@register("stg_unmatched", """
SELECT e.event_id, e.provider_id
FROM staging_events e LEFT JOIN stg_provider p ON e.provider_id = p.provider_id
WHERE p.provider_id IS NULL""", ("staging_events", "stg_provider"))
def q_stg_unmatched(spark, d):
    return keys.stg_unmatched(_staging(spark, d), keys.stg_provider(T.provider_string_source(spark, d)))


@register("match_rate", """
SELECT COUNT(*) AS total_events, COUNT(p.provider_id) AS matched_events,
       COUNT(*) - COUNT(p.provider_id) AS unmatched_events
FROM staging_events e LEFT JOIN stg_provider p ON e.provider_id = p.provider_id""",
          ("staging_events", "stg_provider"))
def q_match_rate(spark, d):
    return keys.match_rate(_staging(spark, d), keys.stg_provider(T.provider_string_source(spark, d)))


@register("invalid_key_count", """
SELECT COUNT(*) AS invalid_provider_ids FROM provider_string_source
WHERE TRY_CAST(TRY_CAST(TRIM(provider_id) AS DECIMAL(38,0)) AS BIGINT) IS NULL""",
          ("provider_string_source",))
def q_invalid_key_count(spark, d):
    return keys.invalid_key_count(T.provider_string_source(spark, d))


@register("invalid_keys", """
SELECT * FROM provider_string_source
WHERE TRY_CAST(TRY_CAST(TRIM(provider_id) AS DECIMAL(38,0)) AS BIGINT) IS NULL""",
          ("provider_string_source",))
def q_invalid_keys(spark, d):
    return keys.invalid_keys(T.provider_string_source(spark, d))


@register("invalid_keys_no_trim", """
SELECT * FROM provider_string_source
WHERE TRY_CAST(TRY_CAST(provider_id AS DECIMAL(38,0)) AS BIGINT) IS NULL""",
          ("provider_string_source",))
def q_invalid_keys_no_trim(spark, d):
    return keys.invalid_keys(T.provider_string_source(spark, d), trim=False)


@register("normalized_keys", """
SELECT provider_id, TRY_CAST(TRY_CAST(TRIM(provider_id) AS DECIMAL(38,0)) AS BIGINT) AS normalized_provider_id
FROM provider_string_source""", ("provider_string_source",))
def q_normalized_keys(spark, d):
    return keys.normalized_keys(T.provider_string_source(spark, d))


# --------------------------------------------------------------- usage

_U = f"TIMESTAMP '{USAGE_ASOF}'"


@register("warehouse_credits", f"""
SELECT warehouse_name, CAST(SUM(credits_used) AS DOUBLE) AS credits_used
FROM warehouse_metering_history WHERE start_time >= {_U} - INTERVAL '1' DAY
GROUP BY warehouse_name ORDER BY credits_used DESC""", ("warehouse_metering_history",))
def q_warehouse_credits(spark, d):
    return usage.warehouse_credits(T.warehouse_metering_history(spark, d), USAGE_ASOF)


@register("warehouse_usage_daily", f"""
SELECT CAST(start_time AS DATE) AS usage_date, warehouse_name,
       CAST(ROUND(SUM(credits_used), 3) AS DOUBLE) AS credits_used
FROM warehouse_metering_history WHERE start_time >= {_U} - INTERVAL '7' DAY
GROUP BY CAST(start_time AS DATE), warehouse_name ORDER BY usage_date, warehouse_name""",
          ("warehouse_metering_history",))
def q_warehouse_usage_daily(spark, d):
    return usage.warehouse_usage_daily(T.warehouse_metering_history(spark, d), USAGE_ASOF)


@register("warehouse_usage_compare", f"""
SELECT CAST(start_time AS DATE) AS usage_date, warehouse_name,
       CAST(SUM(credits_used) AS DOUBLE) AS credits_used
FROM warehouse_metering_history WHERE start_time >= {_U} - INTERVAL '7' DAY
GROUP BY CAST(start_time AS DATE), warehouse_name ORDER BY usage_date DESC, credits_used DESC""",
          ("warehouse_metering_history",))
def q_warehouse_usage_compare(spark, d):
    return usage.warehouse_usage_compare(T.warehouse_metering_history(spark, d), USAGE_ASOF)


@register("warehouse_usage_summary", f"""
WITH daily AS (
  SELECT CAST(start_time AS DATE) AS usage_date, warehouse_name, ROUND(SUM(credits_used), 3) AS credits_used
  FROM warehouse_metering_history WHERE start_time >= {_U} - INTERVAL '7' DAY
  GROUP BY CAST(start_time AS DATE), warehouse_name)
SELECT CAST(COALESCE(SUM(credits_used), 0) AS DOUBLE) AS total_credits,
       COUNT(DISTINCT warehouse_name) AS warehouse_count
FROM daily""", ("warehouse_metering_history",))
def q_warehouse_usage_summary(spark, d):
    return usage.warehouse_usage_summary(T.warehouse_metering_history(spark, d), USAGE_ASOF)


@register("repeated_statements", f"""
SELECT query_text, COUNT(*) AS execution_count, CAST(SUM(bytes_scanned) AS BIGINT) AS total_bytes_scanned
FROM query_history
WHERE start_time >= {_U} - INTERVAL '1' DAY AND warehouse_name = '{WAREHOUSE}'
GROUP BY query_text HAVING COUNT(*) > 1 ORDER BY total_bytes_scanned DESC""", ("query_history",))
def q_repeated_statements(spark, d):
    return usage.repeated_statements(T.query_history(spark, d), USAGE_ASOF, WAREHOUSE)


@register("daily_query_volume", f"""
SELECT CAST(start_time AS DATE) AS run_date, COUNT(*) AS query_count,
       CAST(SUM(bytes_scanned) AS BIGINT) AS bytes_scanned
FROM query_history
WHERE warehouse_name = '{WAREHOUSE}' AND start_time >= {_U} - INTERVAL '7' DAY
GROUP BY CAST(start_time AS DATE) ORDER BY run_date DESC""", ("query_history",))
def q_daily_query_volume(spark, d):
    return usage.daily_query_volume(T.query_history(spark, d), USAGE_ASOF, WAREHOUSE)


# ROUND(ms / 1000, 2), half away from zero, in exact integer arithmetic.
_ELAPSED_SQL = """CASE WHEN total_elapsed_time >= 0 THEN ((total_elapsed_time + 5) // 10) / 100
            ELSE -(((-total_elapsed_time) + 5) // 10) / 100 END"""


@register("expensive_queries", f"""
SELECT query_id, user_name, warehouse_name, query_type, start_time,
       {_ELAPSED_SQL} AS elapsed_seconds,
       bytes_scanned, rows_produced, query_text
FROM query_history
WHERE start_time >= {_U} - INTERVAL '1' DAY AND execution_status = 'SUCCESS'
ORDER BY bytes_scanned DESC NULLS LAST, query_id LIMIT 20""", ("query_history",))
def q_expensive_queries(spark, d):
    return usage.expensive_queries(T.query_history(spark, d), USAGE_ASOF)


@register("expensive_queries_raw", f"""
SELECT query_id, user_name, warehouse_name, query_text, start_time, end_time,
       total_elapsed_time, bytes_scanned, rows_produced
FROM query_history WHERE start_time >= {_U} - INTERVAL '1' DAY
ORDER BY bytes_scanned DESC NULLS LAST, query_id LIMIT 20""", ("query_history",))
def q_expensive_queries_raw(spark, d):
    return usage.expensive_queries_raw(T.query_history(spark, d), USAGE_ASOF)


@register("recent_queries", f"""
SELECT query_id, query_text, bytes_scanned, total_elapsed_time, start_time
FROM query_history WHERE warehouse_name = '{WAREHOUSE}'
ORDER BY start_time DESC NULLS LAST, query_id LIMIT 20""", ("query_history",))
def q_recent_queries(spark, d):
    return usage.recent_queries(T.query_history(spark, d), WAREHOUSE)


# --------------------------------------------------------------- explorer

@register("recent_events", """
SELECT event_id, provider_id, event_type, status, event_timestamp, loaded_at
FROM staging_events ORDER BY event_timestamp DESC NULLS LAST, event_id LIMIT 100""", ("staging_events",))
def q_recent_events(spark, d):
    return explorer.recent_events(_staging(spark, d), 100)


_EXPLORER_SQL = f"""
SELECT * FROM (
  SELECT event_id, provider_id, event_type, status, event_timestamp, loaded_at
  FROM staging_events ORDER BY event_timestamp DESC NULLS LAST, event_id LIMIT {EXPLORER_LIMIT}) r
WHERE event_type IN ({', '.join(repr(t) for t in EXPLORER_TYPES)})
  AND status IN ({', '.join(repr(s) for s in EXPLORER_STATUSES)})"""


@register("explorer_filter", _EXPLORER_SQL, ("staging_events",))
def q_explorer_filter(spark, d):
    return explorer.explorer_filter(_staging(spark, d), EXPLORER_TYPES, EXPLORER_STATUSES, EXPLORER_LIMIT)


@register("explorer_row_count", f"SELECT COUNT(*) AS rows_displayed FROM ({_EXPLORER_SQL.strip()}) f",
          ("staging_events",))
def q_explorer_row_count(spark, d):
    rows = explorer.explorer_filter(_staging(spark, d), EXPLORER_TYPES, EXPLORER_STATUSES, EXPLORER_LIMIT)
    return duplicates.row_count(rows, "rows_displayed")


@register("facet_values", """
SELECT DISTINCT facet, value FROM (
  SELECT 'event_type' AS facet, CAST(event_type AS VARCHAR) AS value FROM staging_events
  UNION ALL
  SELECT 'status' AS facet, CAST(status AS VARCHAR) AS value FROM staging_events) f
WHERE value IS NOT NULL ORDER BY facet, value""", ("staging_events",))
def q_facet_values(spark, d):
    return explorer.facet_values(_staging(spark, d))


# --------------------------------------------------------------- incremental loads

@register("append_with_default_load_ts", f"""
SELECT * FROM target_events
UNION ALL
SELECT event_id, provider_id, event_type, status, event_timestamp, TIMESTAMP '{USAGE_ASOF}' AS loaded_at
FROM staging_events WHERE event_timestamp >= TIMESTAMP '{T.TARGET_CUTOFF}'""",
          ("staging_events", "target_events"))
def q_append_with_default_load_ts(spark, d):
    landed = _staging(spark, d).filter(F.col("event_timestamp") >= ntz(T.TARGET_CUTOFF)).drop("loaded_at")
    return incremental.append_with_default_load_ts(T.target_events(spark, d), landed, USAGE_ASOF)


@register("incremental_lookback", f"""
SELECT * FROM source_events WHERE event_timestamp >= {_U} - INTERVAL '1' DAY""", ("source_events",))
def q_incremental_lookback(spark, d):
    return incremental.incremental_lookback(T.source_events(spark, d), USAGE_ASOF)


@register("incremental_vs_full", f"""
SELECT COUNT(*) FILTER (WHERE event_timestamp >= {_U} - INTERVAL '1' DAY) AS incremental_rows,
       COUNT(*) AS full_rows
FROM source_events""", ("source_events",))
def q_incremental_vs_full(spark, d):
    return incremental.incremental_vs_full(T.source_events(spark, d), USAGE_ASOF)


@register("incremental_by_target_max", """
SELECT * FROM source_events
WHERE event_timestamp > (SELECT MAX(event_timestamp) FROM target_events)""",
          ("source_events", "target_events"))
def q_incremental_by_target_max(spark, d):
    return incremental.incremental_by_target_max(T.source_events(spark, d), T.target_events(spark, d))


@register("incremental_by_control", f"""
SELECT * FROM source_events
WHERE event_timestamp > (SELECT last_successful_timestamp FROM pipeline_control
                         WHERE pipeline_name = '{PIPELINE}')""",
          ("source_events", "pipeline_control"))
def q_incremental_by_control(spark, d):
    return incremental.incremental_by_control(T.source_events(spark, d), T.pipeline_control(spark, d), PIPELINE)


@register("advance_watermark", f"""
WITH batch AS (
  SELECT * FROM source_events
  WHERE event_timestamp > (SELECT last_successful_timestamp FROM pipeline_control
                           WHERE pipeline_name = '{PIPELINE}')),
old AS (SELECT MAX(last_successful_timestamp) AS o FROM pipeline_control WHERE pipeline_name = '{PIPELINE}'),
new AS (SELECT MAX(event_timestamp) AS n FROM batch)
SELECT pipeline_name, last_successful_timestamp FROM pipeline_control WHERE pipeline_name <> '{PIPELINE}'
UNION ALL
SELECT '{PIPELINE}' AS pipeline_name, CASE WHEN n IS NULL OR o >= n THEN o ELSE n END AS last_successful_timestamp
FROM old CROSS JOIN new""", ("source_events", "pipeline_control"))
def q_advance_watermark(spark, d):
    control = T.pipeline_control(spark, d)
    batch = incremental.incremental_by_control(T.source_events(spark, d), control, PIPELINE)
    return incremental.advance_watermark(control, PIPELINE, batch)


@register("processed_window", f"""
SELECT MIN(event_timestamp) AS minimum_processed_timestamp,
       MAX(event_timestamp) AS maximum_processed_timestamp,
       COUNT(*) AS rows_processed
FROM staging_events WHERE loaded_at >= TIMESTAMP '{WINDOW_ASOF}' - INTERVAL '1' HOUR""",
          ("staging_events",))
def q_processed_window(spark, d):
    return incremental.processed_window(_staging(spark, d), WINDOW_ASOF)


# --------------------------------------------------------------- prevention controls


MERGE_FROM = "2024-01-28 00:00:00"     # the re-delivered batch overlaps the target's last day and a half
ANOMALY_FACTOR = 2.0
RUNTIME_LIMIT_SECONDS = 300
UNMATCHED_THRESHOLD = 0.05
_BATCH_SQL = "concat('batch_', CAST(CAST({c} AS DATE) AS VARCHAR(10)))"


@register("idempotent_batch_load", f"""
SELECT s.*, {_BATCH_SQL.format(c='s.loaded_at')} AS batch_id FROM staging_events_dup s
WHERE NOT EXISTS (SELECT 1 FROM load_audit a WHERE a.file_name = {_BATCH_SQL.format(c='s.loaded_at')})""",
          ("staging_events_dup", "load_audit"))
def q_idempotent_batch_load(spark, d):
    return controls.idempotent_batch_load(T.staging_events_dup(spark, d), T.load_audit(spark, d))


@register("merge_upsert", f"""
WITH incoming AS (SELECT * FROM staging_events_dup WHERE event_timestamp >= TIMESTAMP '{MERGE_FROM}'),
latest AS (SELECT * FROM incoming WHERE event_id IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id
                             ORDER BY loaded_at DESC NULLS LAST, provider_id NULLS LAST, event_type NULLS LAST,
                                      status NULLS LAST, event_timestamp NULLS LAST) = 1)
SELECT * FROM target_events t WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.event_id = t.event_id)
UNION ALL SELECT * FROM latest
UNION ALL SELECT * FROM incoming WHERE event_id IS NULL""", ("staging_events_dup", "target_events"))
def q_merge_upsert(spark, d):
    incoming = T.staging_events_dup(spark, d).filter(F.col("event_timestamp") >= ntz(MERGE_FROM))
    return controls.merge_upsert(T.target_events(spark, d), incoming)


@register("load_audit", f"""
SELECT {_BATCH_SQL.format(c='loaded_at')} AS file_name, 'STAGING_EVENTS' AS table_name,
       COUNT(*) AS row_count, COUNT(DISTINCT event_id) AS distinct_events,
       COUNT(*) - COUNT(DISTINCT event_id) AS duplicate_rows,
       MIN(loaded_at) AS first_load_time, MAX(loaded_at) AS last_load_time
FROM staging_events_dup GROUP BY {_BATCH_SQL.format(c='loaded_at')}""", ("staging_events_dup",))
def q_load_audit(spark, d):
    return controls.load_audit_report(T.staging_events_dup(spark, d))


@register("contract_report", """
WITH b AS (SELECT COUNT(*) FILTER (WHERE event_id IS NULL) AS kn,
                  COUNT(*) FILTER (WHERE provider_id IS NULL) AS fn,
                  COUNT(*) FILTER (WHERE status IS NOT NULL AND status NOT IN ('APPROVED', 'COMPLETE', 'DENIED')) AS bs
           FROM staging_events_dup),
dk AS (SELECT COUNT(*) AS n FROM (SELECT event_id FROM staging_events_dup GROUP BY event_id HAVING COUNT(*) > 1)),
o AS (SELECT COUNT(*) AS n FROM staging_events_dup e
      WHERE e.provider_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM dim_provider_lookup p WHERE p.provider_id = e.provider_id)),
ty AS (SELECT CAST(typeof((SELECT MAX(provider_id) FROM staging_events_dup))
                   <> typeof((SELECT MAX(provider_id) FROM provider_string_source)) AS BIGINT) AS n),
r AS (
  SELECT 'unique' AS rule, 'event_id' AS column_name, CAST(n AS BIGINT) AS violations FROM dk
  UNION ALL SELECT 'not_null', 'event_id', CAST(kn AS BIGINT) FROM b
  UNION ALL SELECT 'not_null', 'provider_id', CAST(fn AS BIGINT) FROM b
  UNION ALL SELECT 'accepted_values', 'status', CAST(bs AS BIGINT) FROM b
  UNION ALL SELECT 'relationship', 'provider_id', CAST(n AS BIGINT) FROM o
  UNION ALL SELECT 'same_type', 'provider_id', n FROM ty)
SELECT rule, column_name, violations, violations = 0 AS passed FROM r""",
          ("staging_events_dup", "dim_provider_lookup", "provider_string_source"))
def q_contract_report(spark, d):
    return controls.contract_report(T.staging_events_dup(spark, d), T.dim_provider_lookup(spark, d),
                                    T.provider_string_source(spark, d))


_MISSING_DAYS_CTES = """
d AS (SELECT DISTINCT CAST(last_load_time AS DATE) AS load_date FROM load_audit WHERE last_load_time IS NOT NULL),
r AS (SELECT MIN(load_date) AS lo, MAX(load_date) AS hi FROM d),
cal AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
               AS missing_date
        FROM r WHERE lo IS NOT NULL),
missing AS (SELECT missing_date FROM cal WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.load_date = cal.missing_date))"""


@register("missing_load_days", f"WITH {_MISSING_DAYS_CTES} SELECT missing_date FROM missing ORDER BY missing_date",
          ("load_audit",))
def q_missing_load_days(spark, d):
    return controls.missing_load_days(T.load_audit(spark, d))


@register("missing_files", f"""
SELECT DISTINCT {_BATCH_SQL.format(c='e.loaded_at')} AS file_name FROM staging_events e
WHERE e.loaded_at IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM load_audit a WHERE a.file_name = {_BATCH_SQL.format(c='e.loaded_at')})
ORDER BY file_name""", ("staging_events", "load_audit"))
def q_missing_files(spark, d):
    expected = _staging(spark, d).select(controls.batch_id().alias("file_name"))
    return controls.missing_files(expected, T.load_audit(spark, d))


_DAILY_LOADS = "daily AS (SELECT CAST(loaded_at AS DATE) AS load_date, COUNT(*) AS row_count FROM staging_events_dup GROUP BY 1)"


@register("row_growth", f"""
WITH {_DAILY_LOADS}
SELECT d.load_date, d.row_count, p.row_count AS prior_row_count, d.row_count - p.row_count AS row_change,
       CAST(d.row_count - p.row_count AS DOUBLE) / p.row_count AS change_ratio
FROM daily d LEFT JOIN daily p ON p.load_date + 1 = d.load_date ORDER BY d.load_date""", ("staging_events_dup",))
def q_row_growth(spark, d):
    return controls.row_growth(T.staging_events_dup(spark, d))


@register("unmatched_rate", f"""
WITH m AS (SELECT COUNT(*) AS total_events, COUNT(p.provider_id) AS matched_events,
                  COUNT(*) - COUNT(p.provider_id) AS unmatched_events
           FROM staging_events e LEFT JOIN stg_provider p ON e.provider_id = p.provider_id),
r AS (SELECT *, CASE WHEN total_events > 0 THEN CAST(unmatched_events AS DOUBLE) / total_events END AS unmatched_rate
      FROM m)
SELECT *, COALESCE(unmatched_rate > {UNMATCHED_THRESHOLD}, false) AS breach FROM r""",
          ("staging_events", "stg_provider"))
def q_unmatched_rate(spark, d):
    return controls.unmatched_rate(_staging(spark, d), keys.stg_provider(T.provider_string_source(spark, d)),
                                   threshold=UNMATCHED_THRESHOLD)


def _anomaly_sql(table: str, value: str, date_alias: str) -> str:
    return f"""
WITH daily AS (SELECT CAST(start_time AS DATE) AS {date_alias}, warehouse_name, SUM({value}) AS t
               FROM {table} GROUP BY 1, 2),
w AS (SELECT {date_alias}, warehouse_name, CAST(t AS DOUBLE) AS {value},
             COUNT(t) OVER win AS prior_days, SUM(t) OVER win AS ps
      FROM daily
      WINDOW win AS (PARTITION BY warehouse_name ORDER BY date_diff('day', DATE '1970-01-01', {date_alias})
                     RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING)),
a AS (SELECT {date_alias}, warehouse_name, {value}, prior_days,
             CASE WHEN prior_days > 0 THEN CAST(ps AS DOUBLE) / prior_days END AS prior_avg FROM w)
SELECT *, COALESCE({value} > {ANOMALY_FACTOR} * prior_avg, false) AS is_anomaly FROM a
ORDER BY {date_alias}, warehouse_name"""


@register("usage_anomalies", _anomaly_sql("warehouse_metering_history", "credits_used", "usage_date"),
          ("warehouse_metering_history",))
def q_usage_anomalies(spark, d):
    return controls.usage_anomalies(T.warehouse_metering_history(spark, d), ANOMALY_FACTOR)


@register("bytes_anomalies", _anomaly_sql("query_history", "bytes_scanned", "run_date"), ("query_history",))
def q_bytes_anomalies(spark, d):
    return controls.bytes_anomalies(T.query_history(spark, d), ANOMALY_FACTOR)


def _quota_sql(quota: float) -> str:
    return f"""
WITH daily AS (SELECT CAST(start_time AS DATE) AS usage_date, warehouse_name, SUM(credits_used) AS c
               FROM warehouse_metering_history GROUP BY 1, 2),
m AS (SELECT CAST(date_trunc('month', usage_date) AS DATE) AS usage_month, usage_date, warehouse_name,
             CAST(c AS DOUBLE) AS credits_used,
             CAST(SUM(c) OVER (PARTITION BY warehouse_name, date_trunc('month', usage_date) ORDER BY usage_date
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS month_to_date_credits
      FROM daily),
p AS (SELECT *, month_to_date_credits * CAST(100.0 AS DOUBLE) / CAST({quota} AS DOUBLE) AS quota_used_pct FROM m),
l AS (SELECT *, CASE WHEN quota_used_pct >= 100.0 THEN 100 WHEN quota_used_pct >= 90.0 THEN 90
                     WHEN quota_used_pct >= 75.0 THEN 75 ELSE 0 END AS quota_level FROM p)
SELECT *, CASE WHEN quota_level >= 100 THEN 'SUSPEND' WHEN quota_level > 0 THEN 'NOTIFY' ELSE 'NONE' END
          AS quota_action
FROM l ORDER BY usage_date, warehouse_name"""


@register("credit_quota_status", _quota_sql(100.0), ("warehouse_metering_history",))
def q_credit_quota_status(spark, d):
    return controls.credit_quota_status(T.warehouse_metering_history(spark, d))


@register("long_running_queries", f"""
SELECT query_id, user_name, warehouse_name, start_time, total_elapsed_time FROM query_history
WHERE total_elapsed_time > {RUNTIME_LIMIT_SECONDS * 1000} ORDER BY total_elapsed_time DESC, query_id""",
          ("query_history",))
def q_long_running_queries(spark, d):
    return controls.long_running_queries(T.query_history(spark, d), RUNTIME_LIMIT_SECONDS)


_CHECKLIST_SQL = f"""
WITH lat AS (SELECT MAX(loaded_at) AS l FROM staging_events_dup),
{_MISSING_DAYS_CTES.strip()},
miss AS (SELECT CAST(COUNT(*) AS DOUBLE) AS m2 FROM missing),
{_DAILY_LOADS},
g AS (SELECT d1.load_date, d1.row_count AS rc, p.row_count AS prc
      FROM daily d1 JOIN daily p ON p.load_date + 1 = d1.load_date),
growth AS (SELECT CAST(max_by(rc, load_date) AS DOUBLE) / max_by(prc, load_date) AS m4 FROM g),
pk AS (SELECT event_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE provider_id IS NULL) AS nulls
       FROM staging_events_dup GROUP BY event_id),
k AS (SELECT CAST(COUNT(*) FILTER (WHERE n > 1) AS DOUBLE) AS m5, CAST(COALESCE(SUM(nulls), 0) AS DOUBLE) AS m6,
             CAST(COALESCE(SUM(n - 1), 0) AS DOUBLE) AS m8, COALESCE(SUM(n), 0) AS total_rows FROM pk),
inv AS (SELECT CAST(COUNT(*) AS DOUBLE) AS m7 FROM provider_string_source
        WHERE TRY_CAST(TRY_CAST(TRIM(provider_id) AS DECIMAL(38,0)) AS BIGINT) IS NULL),
cur AS (SELECT CAST(event_timestamp AS DATE) AS event_date, event_type, status, COUNT(*) AS event_count
        FROM staging_events_dup GROUP BY 1, 2, 3),
gr AS (SELECT COALESCE(SUM(event_count), 0) AS cs, COUNT(*) AS n_groups,
              COUNT(DISTINCT struct_pack(event_date, event_type, status)) AS n_distinct FROM cur),
an AS ({_anomaly_sql("warehouse_metering_history", "credits_used", "usage_date").replace("ORDER BY usage_date, warehouse_name", "")}),
an_c AS (SELECT CAST(COUNT(*) FILTER (WHERE is_anomaly) AS DOUBLE) AS m10 FROM an
         WHERE usage_date >= CAST(TIMESTAMP '{FRESHNESS_ASOF}' - INTERVAL '1' DAY AS DATE)),
rw AS (SELECT CASE WHEN l IS NULL THEN 0.0 ELSE 1.0 END AS m1, m2,
              CASE WHEN l IS NULL THEN NULL
                   ELSE (epoch_us(TIMESTAMP '{FRESHNESS_ASOF}') - epoch_us(l)) / 3.6e9 END AS m3,
              m4, m5, m6, m7, m8,
              CAST(cs - total_rows AS DOUBLE) + CAST(n_groups - n_distinct AS DOUBLE) AS m9, m10
       FROM lat, miss, growth, k, inv, gr, an_c)
SELECT 1 AS check_no, 'pipeline_ran' AS check_name, CAST(m1 AS DOUBLE) AS metric, COALESCE(m1 = 1, false) AS passed FROM rw
UNION ALL SELECT 2, 'source_arrived', m2, COALESCE(m2 = 0, false) FROM rw
UNION ALL SELECT 3, 'data_fresh', m3, COALESCE(m3 IS NOT NULL AND m3 <= 24.0, false) FROM rw
UNION ALL SELECT 4, 'row_count_reasonable', m4, COALESCE(m4 IS NULL OR (m4 >= 0.5 AND m4 <= 2.0), false) FROM rw
UNION ALL SELECT 5, 'keys_unique', m5, COALESCE(m5 = 0, false) FROM rw
UNION ALL SELECT 6, 'no_null_keys', m6, COALESCE(m6 = 0, false) FROM rw
UNION ALL SELECT 7, 'join_key_types_compatible', m7, COALESCE(m7 = 0, false) FROM rw
UNION ALL SELECT 8, 'no_reprocessing', m8, COALESCE(m8 = 0, false) FROM rw
UNION ALL SELECT 9, 'expected_grain', m9, COALESCE(m9 = 0, false) FROM rw
UNION ALL SELECT 10, 'usage_stable', m10, COALESCE(m10 = 0, false) FROM rw"""


@register("incident_checklist", _CHECKLIST_SQL,
          ("staging_events_dup", "load_audit", "provider_string_source", "warehouse_metering_history"))
def q_incident_checklist(spark, d):
    staging = T.staging_events_dup(spark, d)
    return controls.incident_checklist(
        staging, baseline.curated_daily_events(staging), T.load_audit(spark, d),
        T.provider_string_source(spark, d), T.warehouse_metering_history(spark, d), FRESHNESS_ASOF)


# --------------------------------------------------------------- cases that reach every branch

_MONTHLY_QUOTA = 1600.0   # near a month's credits of one warehouse: every level is passed on the way
_TIGHT_FACTOR = 1.1


@register("credit_quota_levels", _quota_sql(_MONTHLY_QUOTA), ("warehouse_metering_history",))
def q_credit_quota_levels(spark, d):
    return controls.credit_quota_status(T.warehouse_metering_history(spark, d), quota=_MONTHLY_QUOTA)


@register("usage_anomalies_tight", _anomaly_sql("warehouse_metering_history", "credits_used", "usage_date")
          .replace(f"> {ANOMALY_FACTOR} *", f"> {_TIGHT_FACTOR} *"), ("warehouse_metering_history",))
def q_usage_anomalies_tight(spark, d):
    return controls.usage_anomalies(T.warehouse_metering_history(spark, d), _TIGHT_FACTOR)


@register("bytes_anomalies_recent", f"""
SELECT * FROM ({_anomaly_sql("query_history", "bytes_scanned", "run_date").replace(f"> {ANOMALY_FACTOR} *", f"> {_TIGHT_FACTOR} *")
               .replace("ORDER BY run_date, warehouse_name", "")}) z
WHERE run_date >= CAST({_U} - INTERVAL '7' DAY AS DATE)""", ("query_history",))
def q_bytes_anomalies_recent(spark, d):
    return controls.bytes_anomalies(T.query_history(spark, d), _TIGHT_FACTOR, asof=USAGE_ASOF, days=7)


@register("long_running_queries_recent", f"""
SELECT query_id, user_name, warehouse_name, start_time, total_elapsed_time FROM query_history
WHERE total_elapsed_time > 60000 AND start_time >= {_U} - INTERVAL '7' DAY""", ("query_history",))
def q_long_running_queries_recent(spark, d):
    return controls.long_running_queries(T.query_history(spark, d), 60, asof=USAGE_ASOF, days=7)


@register("row_growth_unloaded", f"""
WITH {_DAILY_LOADS.replace("staging_events_dup", "staging_events_unloaded")}
SELECT d.load_date, d.row_count, p.row_count AS prior_row_count, d.row_count - p.row_count AS row_change,
       CAST(d.row_count - p.row_count AS DOUBLE) / p.row_count AS change_ratio
FROM daily d LEFT JOIN daily p ON p.load_date + 1 = d.load_date""", ("staging_events_unloaded",))
def q_row_growth_unloaded(spark, d):
    return controls.row_growth(T.staging_events_unloaded(spark, d))


@register("rejected_statuses", """
SELECT 'accepted_values' AS rule, 'status' AS column_name, COUNT(*) AS violations, COUNT(*) = 0 AS passed
FROM staging_events WHERE status NOT IN ('APPROVED', 'COMPLETE')""", ("staging_events",))
def q_rejected_statuses(spark, d):
    report = controls.contract_report(_staging(spark, d), T.dim_provider_lookup(spark, d), accepted=EXPLORER_STATUSES)
    return report.filter(F.col("rule") == "accepted_values")


@register("not_in_without_errors", """
SELECT provider_id FROM dim_provider_lookup
WHERE provider_id NOT IN (SELECT provider_id FROM staging_events WHERE event_type = 'error' AND provider_id IS NOT NULL)""",
          ("staging_events", "dim_provider_lookup"))
def q_not_in_without_errors(spark, d):
    errors = _staging(spark, d).filter((F.col("event_type") == "error") & F.col("provider_id").isNotNull())
    return exclusion.not_in_keys(T.dim_provider_lookup(spark, d), errors)


# --------------------------------------------------------------- A4, D7, A16, A17, F1b, F2, D23, stored logs

@register("replay_then_dedup", "SELECT * FROM staging_events", ("staging_events",))
def q_replay_then_dedup(spark, d):
    return duplicates.dedup_keep_first(duplicates.replay_batch(_staging(spark, d)))


@register("duplicated_key_count", """
SELECT COUNT(*) AS duplicate_event_ids
FROM (SELECT event_id FROM staging_events_dup GROUP BY event_id HAVING COUNT(*) > 1) k""", ("staging_events_dup",))
def q_duplicated_key_count(spark, d):
    return duplicates.duplicated_key_count(T.staging_events_dup(spark, d))


@register("available_columns", "SELECT event_id, status FROM staging_events", ("staging_events",))
def q_available_columns(spark, d):
    upper = _staging(spark, d)
    upper = upper.toDF(*[c.upper() for c in upper.columns])
    return explorer.select_available(explorer.normalize_columns(upper), ["event_id", "no_such_column", "status"])


@register("curated_newest_first", "SELECT * FROM curated_daily_events", ("curated_daily_events",))
def q_curated_newest_first(spark, d):
    return baseline.curated_newest_first(_curated(spark, d))


@register("lookup_ordered", "SELECT * FROM dim_provider_lookup", ("dim_provider_lookup",))
def q_lookup_ordered(spark, d):
    return baseline.lookup_ordered(T.dim_provider_lookup(spark, d))


@register("facets_of_recent_events", f"""
WITH r AS (SELECT event_type, status FROM staging_events
           ORDER BY event_timestamp DESC NULLS LAST, event_id LIMIT {EXPLORER_LIMIT})
SELECT DISTINCT facet, value FROM (
  SELECT 'event_type' AS facet, event_type AS value FROM r UNION ALL SELECT 'status', status FROM r) f
WHERE value IS NOT NULL""", ("staging_events",))
def q_facets_of_recent_events(spark, d):
    return explorer.facet_values(explorer.recent_events(_staging(spark, d), EXPLORER_LIMIT))


@register("stored_warehouse_credits", f"""
SELECT warehouse_name, CAST(SUM(credits_used) AS DOUBLE) AS credits_used
FROM warehouse_metering_history WHERE start_time >= {_U} - INTERVAL '1' DAY
GROUP BY warehouse_name""", ("warehouse_metering_history",))
def q_stored_warehouse_credits(spark, d):
    path = sinks.scratch_table(T.warehouse_metering_history(spark, d), "metering")
    return usage.warehouse_credits(readers.read_metering(spark, path), USAGE_ASOF)


@register("stored_recent_queries", f"""
SELECT query_id, query_text, bytes_scanned, total_elapsed_time, start_time
FROM query_history WHERE warehouse_name = '{WAREHOUSE}'
ORDER BY start_time DESC NULLS LAST, query_id LIMIT 20""", ("query_history",))
def q_stored_recent_queries(spark, d):
    path = sinks.scratch_table(T.query_history(spark, d), "query-history")
    return usage.recent_queries(readers.read_query_history(spark, path), WAREHOUSE)


from freshet.plans import maintained  # noqa: E402,F401  registers the queries of the maintained tables
