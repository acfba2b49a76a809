"""Build an enlarged copy of the test tables for a scaling check.

Usage: python scripts/scale_probe.py <src_sf_dir> <fresh_out_dir> <copies>
Replicates ``events`` and ``lineitem`` ``copies`` times with offset keys (so
keys stay unique per copy and duplicates keep their pattern) and writes them,
with ``customer`` unchanged, as multi-file Parquet under ``<fresh_out_dir>``.
Then run ``BENCH_SF_DIR=<fresh_out_dir> python bench.py`` and compare with the
source scale: per-query times should grow about linearly.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    src, out, copies = sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/"), int(sys.argv[3])
    from freshet.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    rep = spark.range(copies).withColumnRenamed("id", "_copy")
    ev = spark.read.parquet(f"{src}/events.parquet")
    (ev.crossJoin(rep).withColumn("event_id", F.col("event_id") + F.col("_copy") * F.lit(10_000_000_000))
       .drop("_copy").repartition(8 * copies).write.parquet(f"{out}/events.parquet"))
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    (li.crossJoin(rep).withColumn("l_orderkey", F.col("l_orderkey") + F.col("_copy") * F.lit(10_000_000_000))
       .drop("_copy").repartition(8 * copies).write.parquet(f"{out}/lineitem.parquet"))
    spark.read.parquet(f"{src}/customer.parquet").write.parquet(f"{out}/customer.parquet")
    spark.stop()
    print(out)


if __name__ == "__main__":
    main()
