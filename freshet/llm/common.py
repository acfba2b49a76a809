"""Helpers shared by the operators of this package.

* ``stored`` cuts lineage with a written Parquet table in the shared folder the
  cluster names in ``spark.checkpoint.dir``; what it returns survives the loss
  of any executor.
* ``ready`` sets the session's runtime options the operators assume. Arrow
  batches are bounded in bytes, so one batch of very long texts cannot fill a
  Python worker.
* Rows of ``documents`` are told apart by (doc_id, hash of the text): repeated
  rows then give repeated, equal results, and no operator depends on row order.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ARROW_BATCH_ROWS = 2_000
ARROW_BATCH_BYTES = 4 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors' Python workers (what --py-files does), once an application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        top, name = os.path.split(package)
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="freshet-py-"), name), "zip", top, name))
        _shipped.add(sc.applicationId)


def ready(spark: SparkSession) -> SparkSession:
    ship(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a scratch folder only for an unset local session."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="freshet-shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back with the same schema."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    give_back(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more, and let the driver collect what finished jobs left.

    Spark removes the shuffle files and broadcasts of a finished job from all executors when the driver's
    garbage collector meets the objects that stood for them; a driver with little to do may not run
    it for long, so disks keep the files of every step. Only call it on tables whose successors are written.
    What the driver has freed outside its heap goes back to the system as well (``give_back``).
    """
    for t in tables:
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    spark.sparkContext._jvm.System.gc()
    give_back(spark)


def give_back(spark: SparkSession) -> bool:
    """Return to the system what the driver's JVM has freed outside its heap; False where the JVM can't.

    Compilers and threads free what they took, but the C library keeps it for each of them, so a driver that
    plans many queries holds ever more. OpenJDK from 17.0.9 on has a diagnostic command for it.
    """
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    name = jvm.java.lang.Class.forName
    kinds, given = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
    for k, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[k] = name(kind)
    try:  # the server's own class is not open to Py4J, the interface is
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        name("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, given)
    except Py4JError:
        return False
    return True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """64-bit hash of a text; NULL and '' differ from every other text and from each other."""
    return F.when(F.col(text).isNull(), F.lit(-1).cast("long")).otherwise(F.xxhash64(F.col(text)))


def same_row(left: DataFrame, right: DataFrame, *cols: str) -> Column:
    """Null-safe equality on ``cols``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def crc_mod(doc_id: str, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (NULL ids count as remainder -1)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % m, F.lit(-1))


def smallest_hashes(ids: DataFrame, by: str, most: Column) -> DataFrame:
    """Of rows (id, ``by``): the ``most`` smallest hashes of the distinct ids of each group, as (id, ``by``, r).

    An id counts once however many rows it has, with the smallest of its groups that the bound below lets
    through. The bound is on the hash: from the group's number of distinct ids, estimated within a hundredth,
    it is set so that somewhat more than ``most`` pass (all of a smaller group), whatever the table's size. Only those
    are shuffled and ranked, so no task meets a whole group.
    """
    span = 1 << 40
    h = F.pmod(F.xxhash64("id"), F.lit(span))
    # a sketch is one column; the buffer of approx_count_distinct(id, 0.01) is 1,639 columns, which the driver plans and compiles
    groups = ids.groupBy(by).agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.when(F.col("id").isNotNull(), F.xxhash64("id")), F.lit(14))).alias("n"))
    wanted = most * 1.06 + F.sqrt(most.cast("double")) * 6 + 64
    groups = groups.select(F.col(by).alias("__of"), (wanted / F.greatest(F.col("n"), F.lit(1)) * span).alias("__below"))
    few = (ids.select("id", by).join(groups, F.col(by) == F.col("__of")).filter(h < F.col("__below"))
           .groupBy("id").agg(F.min(by).alias(by)))
    rank = Window.partitionBy(by).orderBy(h, "id")
    return few.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= most).select("id", by, "r")


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def int_lists(flat: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from concatenated values and row lengths."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def chunks_of(texts: list[bytes | None], most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (a longer single text is its own range)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def split64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit mix: spreads every input bit over the whole word (in place)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
