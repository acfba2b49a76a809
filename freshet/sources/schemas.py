"""A1: declared table schemas (warehouse DDL re-expressed as StructTypes)."""

from __future__ import annotations

from pyspark.sql import types as T

STAGING_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("provider_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("event_timestamp", T.TimestampNTZType(), True),
    T.StructField("loaded_at", T.TimestampNTZType(), True),
])

DIM_PROVIDER_LOOKUP = T.StructType([
    T.StructField("provider_id", T.LongType(), True),
    T.StructField("provider_name", T.StringType(), True),
    T.StructField("specialty", T.StringType(), True),
])

CURATED_DAILY_EVENTS = T.StructType([
    T.StructField("event_date", T.DateType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("event_count", T.LongType(), True),
])

PROVIDER_STRING_SOURCE = T.StructType([
    T.StructField("provider_id", T.StringType(), True),
    T.StructField("provider_name", T.StringType(), True),
])

PIPELINE_CONTROL = T.StructType([
    T.StructField("pipeline_name", T.StringType(), True),
    T.StructField("last_successful_timestamp", T.TimestampNTZType(), True),
])

# The composite mark of ``streaming.marks``: the last row read in the order (timestamp, key).
PIPELINE_MARKS = T.StructType([
    T.StructField("pipeline_name", T.StringType(), True),
    T.StructField("last_successful_timestamp", T.TimestampNTZType(), True),
    T.StructField("last_successful_key", T.LongType(), True),
])

QUERY_HISTORY = T.StructType([
    T.StructField("query_id", T.StringType(), True),
    T.StructField("user_name", T.StringType(), True),
    T.StructField("warehouse_name", T.StringType(), True),
    T.StructField("query_type", T.StringType(), True),
    T.StructField("query_text", T.StringType(), True),
    T.StructField("start_time", T.TimestampNTZType(), True),
    T.StructField("end_time", T.TimestampNTZType(), True),
    T.StructField("total_elapsed_time", T.LongType(), True),
    T.StructField("bytes_scanned", T.LongType(), True),
    T.StructField("rows_produced", T.LongType(), True),
    T.StructField("execution_status", T.StringType(), True),
])

WAREHOUSE_METERING_HISTORY = T.StructType([
    T.StructField("start_time", T.TimestampNTZType(), True),
    T.StructField("warehouse_name", T.StringType(), True),
    T.StructField("credits_used", T.DecimalType(18, 6), True),
])

# The stored daily rollup of the metering log (``streaming.refresh``).
USAGE_DAILY = T.StructType([
    T.StructField("usage_date", T.DateType(), True),
    T.StructField("warehouse_name", T.StringType(), True),
    T.StructField("credits_used", T.DecimalType(28, 6), True),
])

LOAD_AUDIT = T.StructType([
    T.StructField("file_name", T.StringType(), True),
    T.StructField("table_name", T.StringType(), True),
    T.StructField("last_load_time", T.TimestampNTZType(), True),
    T.StructField("row_count", T.LongType(), True),
])

# The audit written with each batch (``streaming.batches``), stored by batch (``file_name``).
BATCH_AUDIT = T.StructType([
    T.StructField("table_name", T.StringType(), True),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("first_load_time", T.TimestampNTZType(), True),
    T.StructField("last_load_time", T.TimestampNTZType(), True),
    T.StructField("file_name", T.StringType(), True),
])

SCHEMAS: dict[str, T.StructType] = {
    "staging_events": STAGING_EVENTS,
    "source_events": STAGING_EVENTS,
    "target_events": STAGING_EVENTS,
    "dim_provider_lookup": DIM_PROVIDER_LOOKUP,
    "curated_daily_events": CURATED_DAILY_EVENTS,
    "provider_string_source": PROVIDER_STRING_SOURCE,
    "pipeline_control": PIPELINE_CONTROL,
    "pipeline_marks": PIPELINE_MARKS,
    "query_history": QUERY_HISTORY,
    "warehouse_metering_history": WAREHOUSE_METERING_HISTORY,
    "load_audit": LOAD_AUDIT,
}
