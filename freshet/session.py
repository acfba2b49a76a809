"""Session construction with the settings every operator assumes."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the operators rely on. UTC makes TIMESTAMP_NTZ arithmetic and
# ``to_date`` match the warehouse semantics; AQE re-plans joins from measured
# shuffle sizes (broadcast only when the runtime size is under the threshold,
# split skewed partitions otherwise).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


# A starting profile for a large cluster (pass as ``extra_conf``). Shuffle
# partitions are set high and AQE coalesces them to the advisory size, so
# the same jobs fit both a small daily slice and a full 100 TB backfill;
# skewed partitions are split once they exceed both the factor and the size.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(master: str | None = None, app_name: str = "freshet",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark
