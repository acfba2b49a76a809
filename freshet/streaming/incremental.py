"""Incremental loading from a stored high-water mark (batch, not Structured Streaming).

The incident reports' "watermark" is a timestamp kept in a control table and
advanced after each successful batch. The bound is read first, as one value,
and applied as a literal filter, so Catalyst pushes it into the Parquet scan
(row-group skipping, and partition pruning on date-partitioned sources):
an incremental run reads only the new slice, which is the point of the fix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions import asof_or_now, at_or_after, in_lookback, ntz, since
from freshet.operators.joins import attach_scalars


def append_with_default_load_ts(base: DataFrame, new: DataFrame, load_ts=None,
                                column: str = "loaded_at") -> DataFrame:
    """A3: append rows, giving a missing/NULL load time its default (the load time)."""
    if column not in new.columns:
        new = new.withColumn(column, F.lit(None).cast(base.schema[column].dataType))
    new = new.withColumn(column, F.coalesce(F.col(column), asof_or_now(load_ts)))
    return base.unionByName(new.select(*base.columns), allowMissingColumns=False)


def incremental_lookback(source: DataFrame, asof=None, days: int = 1,
                         col: str = "event_timestamp", date_col: str | None = None) -> DataFrame:
    """Rows inside a fixed look-back (``>= asof - days``)."""
    return source.filter(in_lookback(col, asof, days, "day", date_col))


def incremental_vs_full(source: DataFrame, asof=None, days: int = 1,
                        col: str = "event_timestamp") -> DataFrame:
    """K11 vs A9: rows the incremental filter reads against the unfiltered scan (one pass)."""
    return source.agg(F.count_if(F.col(col) >= since(asof, days, "day")).alias("incremental_rows"),
                      F.count(F.lit(1)).alias("full_rows"))


def max_value(df: DataFrame, col: str):
    """The maximum of one column as a Python value (one bounded aggregate row)."""
    return df.agg(F.max(col).alias("_m")).first()["_m"]


def incremental_by_target_max(source: DataFrame, target: DataFrame, col: str = "event_timestamp",
                              inclusive: bool = False, on_empty: str = "none",
                              date_col: str | None = None) -> DataFrame:
    """Source rows after the target's maximum (``> (SELECT MAX ...)``).

    An empty target has a NULL maximum, so the faithful result is no rows
    (the first-load trap); ``on_empty='all'`` loads everything instead. On a target
    partitioned by ``date_col`` (the date of ``col``) only its newest partition is read.
    """
    if date_col and date_col in target.columns:
        newest = max_value(target.select(date_col), date_col)
        target = target.filter(F.col(date_col) == F.lit(newest)) if newest is not None else target
    bound = max_value(target, col)
    if bound is None:
        return source if on_empty == "all" else source.filter(F.lit(False))
    return source.filter(at_or_after(col, ntz(bound), date_col, inclusive))


def read_watermark(control: DataFrame, pipeline: str) -> object:
    """The stored high-water mark of one pipeline (NULL when absent)."""
    return (control.filter(F.col("pipeline_name") == F.lit(pipeline))
                   .agg(F.max("last_successful_timestamp").alias("_w")).first()["_w"])


def incremental_by_control(source: DataFrame, control: DataFrame, pipeline: str,
                           col: str = "event_timestamp", inclusive: bool = False,
                           on_empty: str = "all", date_col: str | None = None) -> DataFrame:
    """Source rows after the pipeline's stored watermark.

    A pipeline with no watermark yet loads everything by default (first run).
    """
    bound = read_watermark(control, pipeline)
    if bound is None:
        return source if on_empty == "all" else source.filter(F.lit(False))
    return source.filter(at_or_after(col, ntz(bound), date_col, inclusive))


def advance_watermark(control: DataFrame, pipeline: str, batch: DataFrame,
                      col: str = "event_timestamp") -> DataFrame:
    """The new control rows after a successful batch.

    Other pipelines are kept; this pipeline's mark moves to the batch
    maximum, and never backwards (an empty batch keeps the old mark). Write
    the result with ``replace_table`` only after the batch itself is stored.
    """
    others = control.filter(F.col("pipeline_name") != F.lit(pipeline))
    old = (control.filter(F.col("pipeline_name") == F.lit(pipeline))
                  .agg(F.max("last_successful_timestamp").alias("_old")))
    new = batch.agg(F.max(col).alias("_new"))
    mark = F.when(F.col("_new").isNull() | (F.col("_old") >= F.col("_new")), F.col("_old")).otherwise(F.col("_new"))
    advanced = attach_scalars(old, new).select(F.lit(pipeline).alias("pipeline_name"),
                                               mark.alias("last_successful_timestamp"))
    return others.unionByName(advanced)


def processed_window(target: DataFrame, asof=None, hours: int = 1, date_col: str | None = None) -> DataFrame:
    """Event-time range and row count of rows loaded in the last hours (``date_col``: load-date partition)."""
    return (target.filter(in_lookback("loaded_at", asof, hours, "hour", date_col))
                  .agg(F.min("event_timestamp").alias("minimum_processed_timestamp"),
                       F.max("event_timestamp").alias("maximum_processed_timestamp"),
                       F.count(F.lit(1)).alias("rows_processed")))


def first_per_key(batch: DataFrame, key: str, order: str) -> DataFrame:
    """The earliest row of each key in one pass; rows with a NULL key are all kept, dealt out by a hash."""
    others = [c for c in batch.columns if c not in (key, order)]
    salt = F.when(F.col(key).isNull(), F.xxhash64(*batch.columns)).otherwise(F.lit(0).cast("bigint"))
    first = Window.partitionBy(key, "_salt").orderBy(F.asc_nulls_last(order), *[F.asc_nulls_last(c) for c in others])
    return (batch.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(first))
                 .filter((F.col("_rn") == 1) | F.col(key).isNull()).drop("_salt", "_rn"))


def load_increment(spark, source: DataFrame, target_path: str, control_path: str, pipeline: str,
                   key: str = "event_id", col: str = "event_timestamp", date_col: str | None = None) -> dict:
    """One incremental run: new slice -> idempotent append -> advance the watermark.

    1. read the stored watermark (one value) and filter the source with it
       as a literal (pushed down; partitions pruned when ``date_col`` is set);
    2. keep one row per key of the slice (its earliest load), then append only those
       whose key is not yet in the target, so a rerun after a failure between
       steps 2 and 3 appends nothing twice. Such rows are above the old mark, so only
       that part of the target is read (partitions pruned by ``date_col``);
    3. only then write the advanced control table (new copy, then swap); the
       new mark is the maximum now stored in the target above the old mark.

    Each step is a complete Spark job over files on shared storage: a lost
    executor is recomputed from lineage, and a failed run is simply rerun.
    Rows with a NULL key cannot be matched and are appended as they come.
    Returns the watermark before and after the run.
    """
    from freshet.operators.joins import anti_join, distinct_keys_of
    from freshet.sources import sinks  # imported here: sinks is optional for pure operators

    sinks.ensure_control(spark, control_path)
    control = sinks.read_control(spark, control_path)
    before = read_watermark(control, pipeline)
    batch = incremental_by_control(source, control, pipeline, col=col, date_col=date_col)
    batch = first_per_key(batch, key, "loaded_at" if "loaded_at" in batch.columns else col)
    sinks.recover_table(spark, target_path)
    if sinks.path_exists(spark, target_path):
        existing = spark.read.schema(batch.schema).parquet(target_path)
        if before is not None:
            existing = existing.filter(at_or_after(col, ntz(before), date_col, inclusive=False))
        batch = anti_join(batch, key, distinct_keys_of(existing, key))
    batch.write.mode("append").parquet(target_path)
    stored = spark.read.parquet(target_path)
    if before is not None:
        stored = stored.filter(at_or_after(col, ntz(before), date_col, inclusive=False))
    sinks.replace_table(advance_watermark(control, pipeline, stored, col), control_path)
    after = read_watermark(sinks.read_control(spark, control_path), pipeline)
    return {"watermark_before": before, "watermark_after": after}
