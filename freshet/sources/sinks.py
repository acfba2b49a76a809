"""Sinks and table lifecycle: full refresh, replace-from-self, partition replace, CSV export, control table.

Never overwrite the path a job is reading: Spark does not refuse, and a
failure mid-write loses the table. ``replace_table`` writes a complete new
copy beside the target first and then swaps directories by two renames, so a
lost executor only costs a retry of the write. Between the two renames the path
doesn't exist: a reader that lists it just then fails and must retry. A driver
that dies there leaves the old copy beside the path, and the next call (or
``recover_table``) moves it back. On an object store a rename is a copy; keep such
tables in a format with its own commit log.

``replace_partitions`` changes many partitions, which no single rename can do. It stages their
new content beside the table, marks the copy as complete, and only then overwrites them;
a run that dies in between is finished from the staged copy by the next call or by
``finish_partitions``, and an incomplete copy is dropped with the table untouched. One
writer a table is assumed.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from freshet.sources import schemas


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``.

    Only a local session without that setting gets a scratch folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="freshet-shared-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def scratch_table(df: DataFrame, name: str) -> str:
    """Store ``df`` as a new table in the shared folder (``scratch_path``); returns its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def recover_table(spark: SparkSession, path: str) -> bool:
    """Undo a swap that died between its renames: move the old copy back if the table is gone."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        return False
    _, pattern = _fs(spark, f"{path.rstrip('/')}.__old-*")
    left = sorted(fs.globStatus(pattern) or [], key=lambda s: s.getModificationTime())
    return bool(left) and bool(fs.rename(left[-1].getPath(), target))


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  fmt: str = "parquet", notes: dict[str, str] | None = None) -> str:
    """Replace the table at ``path`` with ``df`` (which may read ``path``).

    ``notes``: small text files (names from ``_`` on, which readers of the table skip) that are swapped with it.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    token = uuid.uuid4().hex[:12]
    staging = f"{path.rstrip('/')}.__new-{token}"
    writer = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(staging)
    for name, text in (notes or {}).items():
        write_text(spark, f"{staging}/{name}", text)
    fs, target = _fs(spark, path)
    _, new = _fs(spark, staging)
    jvm = spark.sparkContext._jvm
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old-{token}")
    had_old = fs.exists(target)
    if had_old and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(new, target):
        if had_old:
            fs.rename(old, target)
        raise OSError(f"could not move new copy into {path}")
    if had_old:
        fs.delete(old, True)
    return path


def write_full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """A5: rerunnable full refresh (TRUNCATE + INSERT) without an empty window."""
    return replace_table(df, path, partition_by)


def write_date_partitioned(df: DataFrame, path: str, ts_col: str, date_col: str) -> str:
    """Store ``df`` partitioned by the date of ``ts_col`` (a new ``date_col`` column).

    Look-back and watermark operators given ``date_col`` then prune whole
    date partitions from the literal bound, on top of row-group skipping. Rows are
    rebalanced by date first: about one file a date on small data, and AQE splits
    hot dates into several files of the advisory size.
    """
    dated = df.withColumn(date_col, F.to_date(ts_col)).hint("rebalance", date_col)
    return replace_table(dated, path, partition_by=[date_col])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there in full or not at all (written beside its place, then renamed)."""
    fs, target = _fs(spark, path)
    _, draft = _fs(spark, f"{path}.__new-{uuid.uuid4().hex[:12]}")
    out = fs.create(draft, False)
    out.write(text.encode())
    out.close()
    if not fs.rename(draft, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


_READY = "_READY"


def write_bucketed(df: DataFrame, table: str, key: str | list[str], buckets: int, path: str | None = None) -> str:
    """Store ``df`` as the table ``table``, bucketed and sorted by ``key``, replacing it; returns its name.

    Rows are dealt to the buckets by one shuffle now, so each bucket is one file. Group-bys, windows and joins
    on the key then need no shuffle, which pays for tables that are checked again and again (duplicates,
    dedup, anti joins). Choose ``buckets`` for the table's size to come: at some 256 MB a bucket, and the
    same number for all tables that are joined. NULL keys share a bucket: keep tables with many of them unbucketed.
    """
    keys = [key] if isinstance(key, str) else list(key)
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite exactly the partitions that ``df`` holds; running it again gives the same table."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> bool:
    """Remove one partition of a table (its directory, named as Spark names it)."""
    fs, _ = _fs(spark, path)
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)
    return bool(fs.delete(_fs(spark, f"{path.rstrip('/')}/{name}")[1], True))


def _apply_staged(spark: SparkSession, staging: str, path: str) -> None:
    """Overwrite the partitions from a complete staged copy, then drop the copy (its marker first)."""
    partition_by = read_text(spark, f"{staging}/{_READY}").split("\n")
    staged = spark.read.parquet(f"{staging}/rows")
    overwrite_partitions(staged, path, partition_by)
    fs, marker = _fs(spark, f"{staging}/{_READY}")
    fs.delete(marker, False)
    fs.delete(_fs(spark, staging)[1], True)


def finish_partitions(spark: SparkSession, path: str) -> int:
    """Finish the partition replaces that died half-way: complete copies are applied, others dropped. Returns how many were applied."""
    fs, pattern = _fs(spark, f"{path.rstrip('/')}.__parts-*")
    left = sorted(fs.globStatus(pattern) or [], key=lambda s: s.getModificationTime())
    applied = 0
    for status in left:
        staging = status.getPath().toString()
        if path_exists(spark, f"{staging}/{_READY}"):
            _apply_staged(spark, staging, path)
            applied += 1
        else:
            fs.delete(status.getPath(), True)
    return applied


def replace_partitions(df: DataFrame, path: str, partition_by: str | list[str]) -> str:
    """Replace exactly the partitions that ``df`` holds (``merge_upsert`` with ``date_col``, ``streaming.refresh``).

    ``df`` may read those partitions: it is staged beside the table first. All of them
    are replaced even if this run dies between two of them (see the module's notes).
    """
    spark, columns = df.sparkSession, [partition_by] if isinstance(partition_by, str) else list(partition_by)
    finish_partitions(spark, path)
    staging = f"{path.rstrip('/')}.__parts-{uuid.uuid4().hex[:12]}"
    df.hint("rebalance", *columns).write.mode("errorifexists").parquet(f"{staging}/rows")
    write_text(spark, f"{staging}/{_READY}", "\n".join(columns))
    _apply_staged(spark, staging, path)
    return path


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with a header, no index, UTF-8; one part file per task (no single-task funnel)."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def ensure_control(spark: SparkSession, path: str, schema: StructType = schemas.PIPELINE_CONTROL) -> str:
    """``CREATE TABLE IF NOT EXISTS pipeline_control`` as an empty typed Parquet table.

    A control table that a died swap left aside is moved back first: an empty one in its
    place would lose every pipeline's mark.
    """
    recover_table(spark, path)
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
    return path


def read_control(spark: SparkSession, path: str, schema: StructType = schemas.PIPELINE_CONTROL) -> DataFrame:
    recover_table(spark, path)
    return spark.read.schema(schema).parquet(path)
