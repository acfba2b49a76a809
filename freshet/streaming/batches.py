"""Batch-keyed idempotent loading: a batch owns its partition of the target, its audit row is written with it.

Every delivery has a batch id. The target is partitioned by it, so loading a batch *is*
overwriting its own partition: a load that failed and is run again, or a batch that is delivered twice,
gives the same table. No anti join against the target is needed and no other batch is read or rewritten.

The audit row (Z3) is observed while the rows are written (``DataFrame.observe``), in the same pass; a
second scan of the batch is not needed. It is stored after the rows, also under the batch id. So the audit
lists complete batches only: ``read_loaded`` reads just those, and a batch half-written by a load that
died stays invisible until it is loaded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from freshet.sources import schemas, sinks
from freshet.streaming.incremental import first_per_key

BATCH_COL = "load_batch"


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, without rows where there is none yet."""
    sinks.finish_partitions(spark, path)
    if not sinks.path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """The audit: one row a completely loaded batch."""
    return _read(spark, audit_path, schemas.BATCH_AUDIT)


def is_loaded(spark: SparkSession, audit_path: str, batch: str) -> bool:
    """Whether the batch is in the audit (reads that batch's audit partition only)."""
    return not read_audit(spark, audit_path).filter(F.col("file_name") == F.lit(batch)).isEmpty()


def load_batch(spark: SparkSession, delivery: DataFrame, target_path: str, audit_path: str, batch: str, key: str = "event_id",
               loaded: str = "loaded_at", table_name: str = "STAGING_EVENTS", keep_duplicates: bool = False,
               skip_loaded: bool = False) -> dict | None:
    """Load one delivery as ``batch`` and write its audit row; returns that row (None: skipped as already loaded).

    A batch keeps one row per key, the earliest, unless ``keep_duplicates``; rows with a NULL key are all
    kept. An empty delivery of a batch that had rows empties it. ``skip_loaded`` leaves a batch that the audit
    lists as it is (Z1's check before processing); else it is replaced by this delivery.
    """
    if not batch:
        raise ValueError("a delivery needs a batch id")
    if skip_loaded and is_loaded(spark, audit_path, batch):
        return None
    seen = Observation()
    rows = delivery if keep_duplicates else first_per_key(delivery, key, loaded)
    rows = rows.withColumn(BATCH_COL, F.lit(batch)).observe(
        seen, F.count(F.lit(1)).alias("row_count"), F.min(loaded).alias("first"), F.max(loaded).alias("last"))
    sinks.overwrite_partitions(rows, target_path, [BATCH_COL])
    got = seen.get
    if not got["row_count"] and sinks.path_exists(spark, target_path):
        sinks.drop_partition(spark, target_path, BATCH_COL, batch)  # an overwrite without rows leaves the old ones
    row = {"table_name": table_name, "row_count": got["row_count"], "first_load_time": got["first"], "last_load_time": got["last"], "file_name": batch}
    audit = spark.createDataFrame([tuple(row.values())], StructType([schemas.BATCH_AUDIT[c] for c in row]))
    sinks.overwrite_partitions(audit, audit_path, ["file_name"])
    return row


def read_loaded(spark: SparkSession, target_path: str, audit_path: str, schema: StructType) -> DataFrame:
    """The rows of completely loaded batches, with their batch (``schema``: that of the deliveries).

    The audit is one row a batch; the semi join on the partition column prunes partitions at run time.
    """
    rows = _read(spark, target_path, StructType([*schema.fields, StructField(BATCH_COL, StringType())]))
    done = read_audit(spark, audit_path).select(F.col("file_name").alias("__done"))
    return rows.join(done, F.col(BATCH_COL) == F.col("__done"), "left_semi")
