"""The derived pipeline tables as SQL, for the DuckDB oracle.

The same derivations as ``freshet.sources.tables`` (which builds them with
the DataFrame API); each oracle query inlines the views it needs as CTEs over
the raw test tables.
"""

from __future__ import annotations

TS = "TIMESTAMP"  # DuckDB spelling of a naive timestamp literal

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "staging_events": ("""
SELECT event_id,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END AS provider_id,
       event_type,
       CASE WHEN value >= 20 THEN 'APPROVED' WHEN value >= 5 THEN 'COMPLETE' ELSE 'DENIED' END AS status,
       ts AS event_timestamp,
       ts + INTERVAL '5' MINUTE AS loaded_at
FROM events""", ()),
    "staging_events_dup": ("""
SELECT * FROM staging_events
UNION ALL
SELECT event_id, provider_id, event_type, status, event_timestamp, loaded_at + INTERVAL '1' HOUR AS loaded_at
FROM staging_events WHERE event_id % 10 = 0""", ("staging_events",)),
    "dim_provider_lookup": ("""
SELECT c_custkey AS provider_id, c_name AS provider_name, c_mktsegment AS specialty
FROM customer WHERE c_custkey % 7 <> 0""", ()),
    "provider_string_source": ("""
SELECT CASE WHEN c_custkey % 11 = 0 THEN concat('X', CAST(c_custkey AS VARCHAR(20)))
            WHEN c_custkey % 5 = 0 THEN concat(CAST(c_custkey AS VARCHAR(20)), ' ')
            ELSE CAST(c_custkey AS VARCHAR(20)) END AS provider_id,
       c_name AS provider_name
FROM customer""", ()),
    "stg_provider": ("""
SELECT TRY_CAST(TRY_CAST(TRIM(provider_id) AS DECIMAL(38,0)) AS BIGINT) AS provider_id, provider_name
FROM provider_string_source""", ("provider_string_source",)),
    "curated_daily_events": ("""
SELECT CAST(event_timestamp AS DATE) AS event_date, event_type, status, COUNT(*) AS event_count
FROM staging_events GROUP BY CAST(event_timestamp AS DATE), event_type, status""", ("staging_events",)),
    "query_history": ("""
SELECT CAST(event_id AS VARCHAR(20)) AS query_id,
       concat('user_', CAST(user_id AS VARCHAR(20))) AS user_name,
       concat('WH_', CAST(user_id % 3 AS VARCHAR(20))) AS warehouse_name,
       event_type AS query_type,
       concat(event_type, ' ', props) AS query_text,
       ts AS start_time,
       ts + INTERVAL '1' MINUTE AS end_time,
       CAST(FLOOR(value * 1000) AS BIGINT) AS total_elapsed_time,
       CAST(FLOOR(value * 1000000) AS BIGINT) AS bytes_scanned,
       CAST(FLOOR(value * 10) AS BIGINT) AS rows_produced,
       CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status
FROM events""", ()),
    "warehouse_metering_history": ("""
SELECT ts AS start_time,
       concat('WH_', CAST(user_id % 3 AS VARCHAR(20))) AS warehouse_name,
       CAST(value / 100 AS DECIMAL(18,6)) AS credits_used
FROM events""", ()),
    "target_events": (f"""
SELECT * FROM staging_events WHERE event_timestamp < {TS} '2024-01-29 12:00:00'""", ("staging_events",)),
    "source_events": ("SELECT * FROM staging_events", ("staging_events",)),
    "pipeline_control": (f"""
SELECT 'EVENT_PIPELINE' AS pipeline_name, {TS} '2024-01-29 12:00:00' AS last_successful_timestamp
UNION ALL SELECT 'USAGE_PIPELINE', {TS} '2024-01-15 00:00:00'""", ()),
    "staging_events_unloaded": ("""
SELECT event_id, provider_id, event_type, status, event_timestamp,
       CASE WHEN event_type = 'error' THEN NULL ELSE loaded_at END AS loaded_at
FROM staging_events""", ("staging_events",)),
    "load_audit": ("""
SELECT concat('batch_', CAST(CAST(loaded_at AS DATE) AS VARCHAR(10))) AS file_name,
       'STAGING_EVENTS' AS table_name,
       MAX(loaded_at) AS last_load_time,
       COUNT(*) AS row_count
FROM staging_events WHERE EXTRACT(DAY FROM loaded_at) <> 13
GROUP BY CAST(loaded_at AS DATE)""", ("staging_events",)),
}


def _resolve(names, out):
    for n in names:
        if n in out:
            continue
        _resolve(VIEWS[n][1], out)
        out.append(n)
    return out


def with_views(body: str, *names: str) -> str:
    """``WITH <views in dependency order> <body>``."""
    order = _resolve(names, [])
    body = body.strip()
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0].strip()})" for n in order)
    if body[:4].upper() == "WITH":
        # the body's own CTEs follow the views they read
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
