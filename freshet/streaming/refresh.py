"""Incremental refresh of stored daily rollups: recompute the touched days, replace their partitions.

A full refresh (A5) reads all of staging to rebuild every day. Here a control table keeps the load time
up to which the rollup is current. A run reads the slice loaded since then, of it only the days its rows
fall on; recomputes just those days from all their rows; and replaces just their partitions. Late
and corrected rows are covered whatever day they belong to, since the slice is chosen by load time
and the days by event time.

The slice starts *at* the mark (less ``overlap``): a day recomputed once more gives the same rows, so rows
with an equal load time can be read twice but never missed. The mark moves last, and the partition replace is
recoverable, so a run that dies anywhere is simply run again.

With ``source_date_col`` (a date partition column of the source, ``sinks.write_date_partitioned``) the days
become a partition filter with literal dates; without it, a range of the timestamps reaches the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import at_or_after, ntz
from freshet.operators import baseline, usage
from freshet.sources import schemas, sinks
from freshet.streaming.incremental import read_watermark

Rollup = Callable[[DataFrame], DataFrame]


def touched_days(source: DataFrame, since: dt.datetime, ts: str = "event_timestamp", loaded: str = "loaded_at",
                 load_date_col: str | None = None) -> tuple[list[dt.date | None], dt.datetime | None]:
    """The days (None: no timestamp) of the rows loaded at or after ``since``, and the last load time among them.

    One row a day reaches the driver: bounded by the calendar, not by the slice.
    """
    rows = (source.filter(at_or_after(loaded, ntz(since), load_date_col))
                  .groupBy(F.to_date(ts).alias("day")).agg(F.max(loaded).alias("last")).collect())
    days = sorted((r["day"] for r in rows), key=lambda d: (d is not None, d or dt.date.min))
    return days, max((r["last"] for r in rows), default=None)


def on_days(days: list[dt.date | None], ts: str = "event_timestamp", date_col: str | None = None) -> Column:
    """Rows of these days, as literals the scan can prune by."""
    dates = [d for d in days if d is not None]
    none = F.lit(False)
    if dates:
        listed = F.to_date(ts).isin(dates)
        if date_col:
            none = F.col(date_col).isin(dates)
        else:
            after = dt.datetime.combine(max(dates), dt.time()) + dt.timedelta(days=1)
            none = listed & (F.col(ts) >= ntz(dt.datetime.combine(min(dates), dt.time()))) & (F.col(ts) < ntz(after))
    if len(dates) < len(days):
        none = none | F.col(date_col or ts).isNull()
    return none


def refresh_days(spark: SparkSession, source: DataFrame, rollup: Rollup, target_path: str, control_path: str, pipeline: str,
                 day_col: str = "event_date", ts: str = "event_timestamp", loaded: str = "loaded_at", overlap: int = 0,
                 source_date_col: str | None = None, load_date_col: str | None = None) -> dict:
    """One refresh of the rollup at ``target_path``, partitioned by ``day_col``; the first run builds all of it.

    ``rollup`` turns source rows into rows of ``day_col`` (the date of ``ts``) and must treat each day alone.
    ``overlap``: seconds before the mark that are looked at again, for loads that commit out of order.
    Returns the marks before and after and the days recomputed (None: all).
    """
    sinks.ensure_control(spark, control_path)
    control = sinks.read_control(spark, control_path)
    before = read_watermark(control, pipeline)
    sinks.finish_partitions(spark, target_path)
    sinks.recover_table(spark, target_path)
    if before is None or not sinks.path_exists(spark, target_path):
        last = source.agg(F.max(loaded).alias("last")).first()["last"]
        sinks.replace_table(rollup(source).hint("rebalance", day_col), target_path, partition_by=[day_col])
        days = None
    else:
        days, last = touched_days(source, before - dt.timedelta(seconds=overlap), ts, loaded, load_date_col)
        if days:
            sinks.replace_partitions(rollup(source.filter(on_days(days, ts, source_date_col))), target_path, day_col)
    after = max((m for m in (before, last) if m is not None), default=None)
    if after != before:
        mark = spark.createDataFrame([(pipeline, after)], schemas.PIPELINE_CONTROL)
        sinks.replace_table(control.filter(F.col("pipeline_name") != F.lit(pipeline)).unionByName(mark), control_path)
    return {"watermark_before": before, "watermark_after": after, "days": days}


def refresh_curated(spark: SparkSession, staging: DataFrame, curated_path: str, control_path: str, pipeline: str = "CURATED_EVENTS",
                    overlap: int = 0, source_date_col: str | None = None, load_date_col: str | None = None) -> dict:
    """D1 + A5 without rereading staging: the curated daily events, touched days only."""
    return refresh_days(spark, staging, baseline.curated_daily_events, curated_path, control_path, pipeline, overlap=overlap,
                        source_date_col=source_date_col, load_date_col=load_date_col)


def read_curated(spark: SparkSession, curated_path: str) -> DataFrame:
    """The stored curated table as declared; a refresh that died half-way is finished first."""
    sinks.finish_partitions(spark, curated_path)
    sinks.recover_table(spark, curated_path)
    return spark.read.schema(schemas.CURATED_DAILY_EVENTS).parquet(curated_path).select(*schemas.CURATED_DAILY_EVENTS.names)


def refresh_usage(spark: SparkSession, metering: DataFrame, rollup_path: str, control_path: str, pipeline: str = "USAGE_DAILY",
                  loaded: str = "loaded_at", overlap: int = 0, source_date_col: str | None = None) -> dict:
    """D16/D17 as a stored rollup: exact credits per day and warehouse, touched days only."""
    return refresh_days(spark, metering, usage.daily_credits, rollup_path, control_path, pipeline, "usage_date", "start_time",
                        loaded, overlap, source_date_col)


def read_usage(spark: SparkSession, rollup_path: str) -> DataFrame:
    """The stored usage rollup in the shape of a metering log, one row a day and warehouse at midnight.

    Sums by day, month or warehouse over it equal those over the log, so every monitor that
    reads whole days (Z9, Z10, D17 from a midnight on) takes it in place of the log.
    """
    sinks.finish_partitions(spark, rollup_path)
    sinks.recover_table(spark, rollup_path)
    rows = spark.read.schema(schemas.USAGE_DAILY).parquet(rollup_path)
    return rows.select(F.col("usage_date").cast("timestamp_ntz").alias("start_time"), "warehouse_name", "credits_used")
