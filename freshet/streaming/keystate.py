"""Maintained key counts: duplicate checks (D3-D7) that read the new slice only.

The state of a set of rows is (key, occurrences, first load, last load), and states are mergeable: that
of a union is the sum, minimum and maximum by key. Each slice is aggregated once, when it
arrives, and its state is stored under the slice's batch id. The state of everything is the merge of the
stored ones: narrow rows, at most one a key and slice, instead of staging's. A slice that is delivered or run again
overwrites its own state, so nothing counts twice.

``compact`` merges the slices' states into one row a key by a swap of directories. It remembers the slices in
it, in a file that moves with the swap, and ``add_slice`` refuses those from then on: their rows are counted.

NULL keys are one group, counted like any other and reported as the queries over staging report it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from freshet.operators.duplicates import dedup_keep_first
from freshet.sources import sinks

SLICE_COL = "slice"
MERGED = "merged"
_SLICES = "_slices"


class AlreadyMerged(ValueError):
    """The slice is part of the compacted state; adding it again would count its rows twice."""


def key_state(rows: DataFrame, key: str = "event_id", loaded: str = "loaded_at") -> DataFrame:
    """(key, occurrences, first_loaded_at, last_loaded_at) of some rows, aggregated on the map side first."""
    return rows.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("occurrences"), F.min(loaded).alias("first_loaded_at"), F.max(loaded).alias("last_loaded_at"))


def merge_states(states: DataFrame, key: str = "event_id") -> DataFrame:
    """One row a key of any number of states."""
    return states.groupBy(F.col(key)).agg(F.sum("occurrences").cast("bigint").alias("occurrences"), F.min("first_loaded_at").alias("first_loaded_at"),
                                          F.max("last_loaded_at").alias("last_loaded_at"))


def merged_slices(spark: SparkSession, path: str) -> set[str]:
    """The slices in the compacted state (one line a slice)."""
    sinks.recover_table(spark, path)
    text = sinks.read_text(spark, f"{path.rstrip('/')}/{_SLICES}")
    return set(text.split("\n")) if text else set()


def add_slice(spark: SparkSession, rows: DataFrame, path: str, slice_id: str, key: str = "event_id", loaded: str = "loaded_at") -> str:
    """Store the state of one new slice; the same slice again replaces it."""
    if not slice_id or slice_id == MERGED or "\n" in slice_id:
        raise ValueError(f"{slice_id!r} can't be a slice id")
    if slice_id in merged_slices(spark, path):
        raise AlreadyMerged(f"{slice_id} is part of the compacted state at {path}")
    sinks.overwrite_partitions(key_state(rows, key, loaded).withColumn(SLICE_COL, F.lit(slice_id)), path, [SLICE_COL])
    return path


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    sinks.recover_table(spark, path)
    return spark.read.schema(StructType([*schema.fields, StructField(SLICE_COL, StringType())])).parquet(path)


def state_schema(rows: StructType, key: str = "event_id", loaded: str = "loaded_at") -> StructType:
    """The schema of the state of rows of this schema."""
    return StructType([StructField(key, rows[key].dataType), StructField("occurrences", LongType()),
                       StructField("first_loaded_at", rows[loaded].dataType), StructField("last_loaded_at", rows[loaded].dataType)])


def read_state(spark: SparkSession, path: str, schema: StructType, key: str = "event_id") -> DataFrame:
    """The merged state, one row a key (``schema``: ``state_schema`` of the rows)."""
    return merge_states(_stored(spark, path, schema), key)


def compact(spark: SparkSession, path: str, schema: StructType, key: str = "event_id") -> int:
    """Merge all stored slices into one state; returns how many slices it holds now."""
    stored = _stored(spark, path, schema)
    new = {r[0] for r in stored.select(SLICE_COL).distinct().collect()} - {MERGED}  # one row a slice
    slices = merged_slices(spark, path) | new
    sinks.replace_table(merge_states(stored, key).withColumn(SLICE_COL, F.lit(MERGED)), path, partition_by=[SLICE_COL],
                        notes={_SLICES: "\n".join(sorted(slices))})
    return len(slices)


def duplicate_keys(state: DataFrame, key: str = "event_id") -> DataFrame:
    """D3 from the state."""
    return state.filter("occurrences > 1").select(key, F.col("occurrences").alias("duplicate_count")).orderBy(F.asc_nulls_last(key))


def duplicate_details(state: DataFrame, key: str = "event_id") -> DataFrame:
    """D4 from the state."""
    return (state.filter("occurrences > 1").select(key, F.col("occurrences").alias("duplicate_count"), "first_loaded_at", "last_loaded_at")
                 .orderBy(F.desc("duplicate_count"), F.asc_nulls_last(key)))


def duplication_extent(state: DataFrame, key: str = "event_id") -> DataFrame:
    """D5 from the state: rows, distinct keys (NULL not counted) and their difference."""
    return (state.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).cast("bigint").alias("total_rows"), F.count(key).alias("unique_events"))
                 .withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_events")))


def new_keys_only(rows: DataFrame, state: DataFrame, key: str = "event_id") -> DataFrame:
    """E1 for a slice: its first row of each key that ``state`` (of earlier slices) doesn't hold.

    With slices in load order the union of the results is ``dedup_keep_first`` of everything. A NULL key is one key,
    as there.
    """
    seen = state.select(F.col(key).alias("__seen"))
    return dedup_keep_first(rows, key).join(seen, F.col(key).eqNullSafe(F.col("__seen")), "left_anti")
