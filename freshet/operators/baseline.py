"""The baseline transformation (staging -> curated) and the curated rollups.

D1 ``curated_daily_events`` is the flagship: one partial hash aggregate per
map task (map-side combine, so a hot day/type/status group never reaches a
single task in full), one hash exchange on the small group key, one final
aggregate. The dashboard rollups (D9-D11) read the curated table, never the
staging table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def curated_daily_events(staging: DataFrame) -> DataFrame:
    """Events per day x type x status."""
    return (staging
            .groupBy(F.to_date("event_timestamp").alias("event_date"), "event_type", "status")
            .agg(F.count(F.lit(1)).alias("event_count")))


def curated_ordered(curated: DataFrame) -> DataFrame:
    """curated rows by date, type, status (validation listing)."""
    return curated.orderBy(F.asc_nulls_last("event_date"), F.asc_nulls_last("event_type"),
                           F.asc_nulls_last("status"))


def curated_newest_first(curated: DataFrame) -> DataFrame:
    """Curated rows, newest date first."""
    return curated.orderBy(F.desc_nulls_first("event_date"), "event_type", "status")


def lookup_ordered(dim: DataFrame, key: str = "provider_id") -> DataFrame:
    """lookup rows in key order."""
    return dim.orderBy(F.asc_nulls_last(key))


def event_trend(curated: DataFrame) -> DataFrame:
    """Total events per day."""
    return (curated.groupBy("event_date")
                   .agg(F.sum("event_count").cast("bigint").alias("total_events"))
                   .orderBy("event_date"))


def _distribution(curated: DataFrame, col: str) -> DataFrame:
    return (curated.groupBy(col)
                   .agg(F.sum("event_count").cast("bigint").alias("event_count"))
                   .orderBy(F.desc("event_count"), F.asc_nulls_last(col)))


def status_distribution(curated: DataFrame) -> DataFrame:
    """Events per status, largest first."""
    return _distribution(curated, "status")


def event_type_distribution(curated: DataFrame) -> DataFrame:
    """Events per event type, largest first."""
    return _distribution(curated, "event_type")
