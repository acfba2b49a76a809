"""Composite high-water marks: the place of the last row read in the order (timestamp, key).

A mark that is only a timestamp loses rows: with ``>`` those that arrive later with the same
timestamp, with ``>=`` the rows at the mark are read again. Here the mark is (timestamp, key), and
rows up to an overlap span older than it are looked at again:

* rows after the mark are new and pass without any look at the target;
* rows at or before it, but at most ``overlap`` seconds older, pass unless the target holds them.
  Both sides of that check read the span alone (a literal bound that reaches the scans and,
  with ``date_col``, prunes partitions), so its cost follows the span, not the target.

Rows with a NULL key have no identity but their content: in the span such a row passes unless the
target holds an equal one. Rows without a timestamp have no place in the order; only a first
run, without a mark, reads them. Rows later than the span are outside the contract and not read.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from freshet.functions import at_or_after, ntz
from freshet.operators.joins import _no_salt
from freshet.sources import schemas, sinks
from freshet.streaming.incremental import first_per_key

BATCH_COL = "load_batch"


class Mark(NamedTuple):
    """The last row read: its timestamp and key (None: only NULL keys were seen at that timestamp)."""

    ts: dt.datetime
    key: int | None

    def batch(self) -> str:
        """The id of the batch that follows this mark."""
        return f"after_{self.ts.strftime('%Y%m%dT%H%M%S.%f')}_{'none' if self.key is None else self.key}"


FIRST_BATCH = "first"


def read_mark(control: DataFrame, pipeline: str) -> Mark | None:
    """The pipeline's stored mark, None before its first run."""
    place = F.struct("last_successful_timestamp", "last_successful_key")
    row = control.filter((F.col("pipeline_name") == F.lit(pipeline)) & F.col("last_successful_timestamp").isNotNull()).agg(F.max(place).alias("m")).first()["m"]
    return None if row is None else Mark(row[0], row[1])


def after_mark(mark: Mark, ts: str = "event_timestamp", key: str = "event_id") -> Column:
    """(ts, key) > mark, NULL keys first: ties of the mark's timestamp go by key."""
    bound = ntz(mark.ts)
    later_key = F.col(key).isNotNull() if mark.key is None else F.coalesce(F.col(key) > F.lit(mark.key), F.lit(False))
    return (F.col(ts) > bound) | ((F.col(ts) == bound) & later_key)


def _span_start(mark: Mark, overlap: int) -> Column:
    return ntz(mark.ts - dt.timedelta(seconds=overlap))


def incremental_by_mark(source: DataFrame, target: DataFrame | None, mark: Mark | None, overlap: int = 0,
                        ts: str = "event_timestamp", key: str = "event_id", date_col: str | None = None) -> DataFrame:
    """K13 with a composite mark: the source rows that are neither lost nor read twice.

    One scan of the source from ``mark.ts - overlap`` on. Rows after the mark get a salt that no
    target row has, so they pass the anti join without a partner and no hot key gathers them.
    ``target``: what was loaded; its rows of the span are read (columns ``key`` and those of NULL-key rows).
    """
    if mark is None:
        return source
    if overlap < 0:
        raise ValueError("the overlap is a number of seconds, zero or more")
    start = _span_start(mark, overlap)
    rows = source.filter(at_or_after(ts, start, date_col))
    if target is None:
        return rows
    columns = [c for c in source.columns if c in target.columns]
    whole = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    held = target.filter(at_or_after(ts, start, date_col) & ~after_mark(mark, ts, key))
    # the identity of a row: its key, or two hashes of all its columns where the key is NULL
    first = F.coalesce(F.col(key).cast("bigint"), whole[0])
    second = F.when(F.col(key).isNull(), whole[1])
    held = held.select(first.alias("__h1"), second.alias("__h2")).distinct()
    new = after_mark(mark, ts, key)
    rows = rows.withColumn("__k1", first).withColumn("__k2", second)
    rows = rows.withColumn("__ls", F.when(new, F.abs(F.xxhash64(*columns) % 1_000_003) + 1).otherwise(F.lit(0).cast("bigint")))
    held = held.withColumn("__rs", _no_salt(F.col("__h1")))
    kept = rows.join(held, (F.col("__k1") == F.col("__h1")) & F.col("__k2").eqNullSafe(F.col("__h2")) & (F.col("__ls") == F.col("__rs")), "left_anti")
    return kept.drop("__k1", "__k2", "__ls")


def advance_mark(control: DataFrame, pipeline: str, batch: DataFrame, ts: str = "event_timestamp", key: str = "event_id") -> DataFrame:
    """K14 with a composite mark: the new control rows. The mark never moves backwards; late rows don't move it."""
    place = F.struct(F.col("last_successful_timestamp").alias("t"), F.col("last_successful_key").cast("bigint").alias("k"))
    mine = control.filter(F.col("pipeline_name") == F.lit(pipeline))
    old = mine.filter(F.col("last_successful_timestamp").isNotNull()).agg(F.max(place).alias("m"))
    new = batch.filter(F.col(ts).isNotNull()).agg(F.max(F.struct(F.col(ts).alias("t"), F.col(key).cast("bigint").alias("k"))).alias("m"))
    best = old.unionByName(new).agg(F.max("m").alias("m"))
    row = best.select(F.lit(pipeline).alias("pipeline_name"), F.col("m.t").alias("last_successful_timestamp"), F.col("m.k").alias("last_successful_key"))
    return control.filter(F.col("pipeline_name") != F.lit(pipeline)).select(*row.columns).unionByName(row)


def load_by_mark(spark: SparkSession, source: DataFrame, target_path: str, control_path: str, pipeline: str, overlap: int = 0,
                 ts: str = "event_timestamp", key: str = "event_id", date_col: str | None = None) -> dict:
    """One incremental run: mark -> new rows -> the mark's own batch partition -> the mark moves on.

    The target is partitioned by ``load_batch``, whose value follows from the mark the run
    started from. A run that died after storing rows is rerun from the same mark, so it overwrites
    its own partition instead of adding to it: nothing is checked against the rows it had stored, and rows of
    other batches are never rewritten. A run that finds only late rows leaves the mark where it is; the next one
    then repeats that batch with what came since. One row per key is kept (its earliest).
    Returns the marks before and after and the batch.
    """
    sinks.ensure_control(spark, control_path, schemas.PIPELINE_MARKS)
    control = sinks.read_control(spark, control_path, schemas.PIPELINE_MARKS)
    mark = read_mark(control, pipeline)
    batch = mark.batch() if mark else FIRST_BATCH
    sinks.finish_partitions(spark, target_path)
    shape = StructType([*source.schema.fields, StructField(BATCH_COL, StringType())])
    others = None
    if sinks.path_exists(spark, target_path):
        others = spark.read.schema(shape).parquet(target_path).filter(F.col(BATCH_COL) != F.lit(batch)).drop(BATCH_COL)
    rows = incremental_by_mark(source, others, mark, overlap, ts, key, date_col)
    rows = first_per_key(rows, key, "loaded_at" if "loaded_at" in rows.columns else ts)
    sinks.replace_partitions(rows.withColumn(BATCH_COL, F.lit(batch)), target_path, BATCH_COL)
    mine = spark.read.schema(shape).parquet(target_path).filter(F.col(BATCH_COL) == F.lit(batch))
    sinks.replace_table(advance_mark(control, pipeline, mine, ts, key), control_path)
    after = read_mark(sinks.read_control(spark, control_path, schemas.PIPELINE_MARKS), pipeline)
    return {"mark_before": mark, "mark_after": after, "batch": batch}
