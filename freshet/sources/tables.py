"""Readers for the raw test tables and the pipeline tables derived from them.

The raw tables (``events``, ``customer``, ``lineitem``) carry no NULL keys,
duplicate loads, string keys or system logs, so the pipeline tables are
derived from them with deterministic fault injection (every 50th event loses
its provider, every 7th provider is missing from the lookup, every 11th
string key is malformed, every 5th has a trailing blank, every 10th event is
loaded twice, day 13 is missing from the load audit). These are not samples:
every derived table covers the whole raw table it is built from, so the work
of each operator grows with the input.

All derivations are narrow projections over one scan, so Catalyst pushes the
operators' filters and column pruning through them into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import ntz

# Fixed values for the derived pipeline tables.
TARGET_CUTOFF = "2024-01-29 12:00:00"
CONTROL_PIPELINE = "EVENT_PIPELINE"
AUDIT_TABLE_NAME = "STAGING_EVENTS"
LOAD_DELAY = "INTERVAL 5 MINUTES"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _str(c: Column) -> Column:
    return c.cast("string")


def staging_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``staging_events`` from ``events``: one row per event, 1 in 50 with a NULL provider."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("long"))
         .otherwise(F.col("user_id")).alias("provider_id"),
        F.col("event_type"),
        F.when(F.col("value") >= 20, F.lit("APPROVED"))
         .when(F.col("value") >= 5, F.lit("COMPLETE"))
         .otherwise(F.lit("DENIED")).alias("status"),
        F.col("ts").alias("event_timestamp"),
        (F.col("ts") + F.expr(LOAD_DELAY)).alias("loaded_at"),
    )


def staging_events_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``staging_events`` with every 10th event loaded a second time an hour later.

    One scan: each event is exploded into its load copies (0 or 0 and 1 hours
    late) instead of a union that would read the table twice.
    """
    base = staging_events(spark, sf_dir)
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (base.select("*", F.explode(copies).alias("_late_hours"))
                .withColumn("loaded_at", F.col("loaded_at") + F.make_dt_interval(hours=F.col("_late_hours")))
                .drop("_late_hours"))


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_events(spark, sf_dir)


def target_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The already-loaded part of the target: events before the cut-off."""
    return staging_events(spark, sf_dir).filter(F.col("event_timestamp") < ntz(TARGET_CUTOFF))


def dim_provider_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider dimension from ``customer``; every 7th provider is missing."""
    c = read_table(spark, sf_dir, "customer")
    return (c.filter(F.col("c_custkey") % 7 != 0)
             .select(F.col("c_custkey").alias("provider_id"),
                     F.col("c_name").alias("provider_name"),
                     F.col("c_mktsegment").alias("specialty")))


def provider_string_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider keys typed as STRING: every 11th malformed, every 5th with a trailing blank."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.when(k % 11 == 0, F.concat(F.lit("X"), _str(k)))
         .when(k % 5 == 0, F.concat(_str(k), F.lit(" ")))
         .otherwise(_str(k)).alias("provider_id"),
        F.col("c_name").alias("provider_name"),
    )


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query-log table from ``events`` (one query per event)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        _str(F.col("event_id")).alias("query_id"),
        F.concat(F.lit("user_"), _str(F.col("user_id"))).alias("user_name"),
        F.concat(F.lit("WH_"), _str(F.col("user_id") % 3)).alias("warehouse_name"),
        F.col("event_type").alias("query_type"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("query_text"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("end_time"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("total_elapsed_time"),
        F.floor(F.col("value") * 1000000).cast("bigint").alias("bytes_scanned"),
        F.floor(F.col("value") * 10).cast("bigint").alias("rows_produced"),
        F.when(F.col("event_type") == "error", F.lit("FAIL"))
         .otherwise(F.lit("SUCCESS")).alias("execution_status"),
    )


def warehouse_metering_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metering-log table from ``events`` (credits as decimal, summed exactly)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("start_time"),
        F.concat(F.lit("WH_"), _str(F.col("user_id") % 3)).alias("warehouse_name"),
        (F.col("value") / 100).cast("decimal(18,6)").alias("credits_used"),
    )


def pipeline_control(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """The high-water-mark control table: one row per pipeline (the second is not ours to move)."""
    return spark.range(2).select(
        F.when(F.col("id") == 0, F.lit(CONTROL_PIPELINE)).otherwise(F.lit("USAGE_PIPELINE")).alias("pipeline_name"),
        F.when(F.col("id") == 0, ntz(TARGET_CUTOFF)).otherwise(ntz("2024-01-15 00:00:00")).alias("last_successful_timestamp"),
    )


def staging_events_unloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``staging_events`` where events of type ``error`` have no load time."""
    return staging_events(spark, sf_dir).withColumn(
        "loaded_at", F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("loaded_at")))


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit row per daily load batch of ``staging_events``; day 13 is missing."""
    st = staging_events(spark, sf_dir).select("loaded_at")
    return (st.filter(F.dayofmonth("loaded_at") != 13)
              .groupBy(F.to_date("loaded_at").alias("load_date"))
              .agg(F.max("loaded_at").alias("last_load_time"),
                   F.count(F.lit(1)).alias("row_count"))
              .select(F.concat(F.lit("batch_"), F.col("load_date").cast("string")).alias("file_name"),
                      F.lit(AUDIT_TABLE_NAME).alias("table_name"),
                      "last_load_time", "row_count"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem")


def file_load_audit(spark: SparkSession, path: str, table_name: str) -> DataFrame:
    """A load audit built from the landed files themselves: one row per file.

    Uses Spark's hidden ``_metadata`` columns (file path, modification time),
    so no data column is read; the result has the ``load_audit`` schema and
    feeds ``load_history``, ``missing_load_days`` and ``missing_files``.
    """
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file_name"),
                                            F.col("_metadata.file_modification_time").alias("_mtime"))
    return (files.groupBy("file_name")
                 .agg(F.max("_mtime").cast("timestamp_ntz").alias("last_load_time"),
                      F.count(F.lit(1)).alias("row_count"))
                 .select("file_name", F.lit(table_name).alias("table_name"), "last_load_time", "row_count"))
