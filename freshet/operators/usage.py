"""Incident 05: compute usage from query-history and metering log tables.

Every report starts with a look-back filter against a literal bound
(``since(asof, n)``), which Catalyst pushes into the Parquet scan; on a log
partitioned by date, pass ``date_col`` and the same bound prunes whole
partitions. Credits are summed as decimals (exact, independent of row
order) and only then rounded and cast.
Top-k reports use ``orderBy().limit()``, which plans as
``TakeOrderedAndProject``: a per-partition top-k and a k-row merge, never a
global sort of the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions import in_lookback, ms_to_seconds

# The reports' top-k size and look-backs.
TOP_K = 20
QUERY_LOOKBACK_DAYS = 1
USAGE_LOOKBACK_DAYS = 7


def _credits(c) -> F.Column:
    return c.cast("double")


def warehouse_credits(metering: DataFrame, asof=None, n: int = 1, unit: str = "day",
                      alias: str = "credits_used", date_col: str | None = None) -> DataFrame:
    """Credits per warehouse over the look-back, largest first."""
    return (metering.filter(in_lookback("start_time", asof, n, unit, date_col))
                    .groupBy("warehouse_name")
                    .agg(_credits(F.sum("credits_used")).alias(alias))
                    .orderBy(F.desc_nulls_last(alias), F.asc_nulls_last("warehouse_name")))


def daily_credits(metering: DataFrame) -> DataFrame:
    """Exact credits per day and warehouse, all days: the rows of the stored rollup (``streaming.refresh``)."""
    return (metering.groupBy(F.to_date("start_time").alias("usage_date"), "warehouse_name")
                    .agg(F.sum("credits_used").cast("decimal(28,6)").alias("credits_used")))


def _daily_credits(metering: DataFrame, asof, days: int, date_col: str | None) -> DataFrame:
    return (metering.filter(in_lookback("start_time", asof, days, "day", date_col))
                    .groupBy(F.to_date("start_time").alias("usage_date"), "warehouse_name")
                    .agg(F.sum("credits_used").alias("_credits")))


def warehouse_usage_daily(metering: DataFrame, asof=None, days: int = USAGE_LOOKBACK_DAYS,
                          date_col: str | None = None) -> DataFrame:
    """Credits per day x warehouse, ``ROUND(SUM, 3)``, by date then warehouse."""
    return (_daily_credits(metering, asof, days, date_col)
            .select("usage_date", "warehouse_name", _credits(F.round("_credits", 3)).alias("credits_used"))
            .orderBy("usage_date", "warehouse_name"))


def warehouse_usage_compare(metering: DataFrame, asof=None, days: int = USAGE_LOOKBACK_DAYS,
                            date_col: str | None = None) -> DataFrame:
    """The same without rounding; newest day first, then largest credits."""
    return (_daily_credits(metering, asof, days, date_col)
            .select("usage_date", "warehouse_name", _credits(F.col("_credits")).alias("credits_used"))
            .orderBy(F.desc("usage_date"), F.desc("credits_used"), "warehouse_name"))


def warehouse_usage_summary(metering: DataFrame, asof=None, days: int = USAGE_LOOKBACK_DAYS,
                            date_col: str | None = None) -> DataFrame:
    """Total credits (sum of the rounded daily values) and distinct warehouses."""
    daily = _daily_credits(metering, asof, days, date_col).withColumn("_r", F.round("_credits", 3))
    return daily.agg(_credits(F.coalesce(F.sum("_r"), F.lit(0))).alias("total_credits"),
                     F.count_distinct("warehouse_name").alias("warehouse_count"))


def repeated_statements(history: DataFrame, asof=None, warehouse: str = "WH_1",
                        days: int = QUERY_LOOKBACK_DAYS, date_col: str | None = None) -> DataFrame:
    """Statements run more than once on one warehouse in the look-back, by bytes."""
    return (history.filter(in_lookback("start_time", asof, days, "day", date_col)
                           & (F.col("warehouse_name") == F.lit(warehouse)))
                   .groupBy("query_text")
                   .agg(F.count(F.lit(1)).alias("execution_count"),
                        F.sum("bytes_scanned").cast("bigint").alias("total_bytes_scanned"))
                   .filter(F.col("execution_count") > 1)
                   .orderBy(F.desc_nulls_last("total_bytes_scanned"), F.asc_nulls_last("query_text")))


def daily_query_volume(history: DataFrame, asof=None, warehouse: str = "WH_1",
                       days: int = USAGE_LOOKBACK_DAYS, date_col: str | None = None) -> DataFrame:
    """Queries and bytes per day on one warehouse, newest day first."""
    return (history.filter((F.col("warehouse_name") == F.lit(warehouse))
                           & in_lookback("start_time", asof, days, "day", date_col))
                   .groupBy(F.to_date("start_time").alias("run_date"))
                   .agg(F.count(F.lit(1)).alias("query_count"),
                        F.sum("bytes_scanned").cast("bigint").alias("bytes_scanned"))
                   .orderBy(F.desc("run_date")))


def _top_by_bytes(df: DataFrame, n: int) -> DataFrame:
    # NULLS LAST on DESC, then the id as a total tie-breaker.
    return df.orderBy(F.desc_nulls_last("bytes_scanned"), F.asc_nulls_last("query_id")).limit(n)


def expensive_queries(history: DataFrame, asof=None, n: int = TOP_K,
                      days: int = QUERY_LOOKBACK_DAYS, date_col: str | None = None) -> DataFrame:
    """top-n successful queries by bytes scanned in the look-back, elapsed in seconds."""
    rows = history.filter(in_lookback("start_time", asof, days, "day", date_col)
                          & (F.col("execution_status") == F.lit("SUCCESS")))
    return _top_by_bytes(rows, n).select(
        "query_id", "user_name", "warehouse_name", "query_type", "start_time",
        ms_to_seconds("total_elapsed_time").alias("elapsed_seconds"),
        "bytes_scanned", "rows_produced", "query_text")


def expensive_queries_raw(history: DataFrame, asof=None, n: int = TOP_K,
                          days: int = QUERY_LOOKBACK_DAYS, date_col: str | None = None) -> DataFrame:
    """Top-n queries by bytes in the look-back, any status, elapsed in ms."""
    rows = history.filter(in_lookback("start_time", asof, days, "day", date_col))
    return _top_by_bytes(rows, n).select(
        "query_id", "user_name", "warehouse_name", "query_text", "start_time", "end_time",
        "total_elapsed_time", "bytes_scanned", "rows_produced")


def recent_queries(history: DataFrame, warehouse: str = "WH_1", n: int = TOP_K) -> DataFrame:
    """the latest n queries of one warehouse (no time filter)."""
    return (history.filter(F.col("warehouse_name") == F.lit(warehouse))
                   .orderBy(F.desc_nulls_last("start_time"), F.asc_nulls_last("query_id"))
                   .limit(n)
                   .select("query_id", "query_text", "bytes_scanned", "total_elapsed_time", "start_time"))
