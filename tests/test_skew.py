"""Skewed inputs: one key holds a third of all rows and another third has a NULL key.

Results are checked against brute-force Spark SQL on the same data; plans are
checked after execution (AQE's final plan), with the skew thresholds scaled
down to this test's size so that AQE sees the hot partition as skewed.
"""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from freshet.operators import duplicates, exclusion, joins, keys

N = 60000
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    ev = spark.range(N).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(101))
         .when(F.col("id") % 3 == 1, F.lit(None))
         .otherwise(F.col("id") % 1000).cast("long").alias("provider_id"),
        F.lit("CLAIM").alias("event_type"),
        F.lit("COMPLETE").alias("status"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("event_timestamp"),
        (F.lit("2024-01-02 00:00:00").cast("timestamp_ntz") - F.make_dt_interval(secs=F.col("id"))).alias("loaded_at"))
    dim = spark.range(0, 1000, 2).select(F.col("id").alias("provider_id"), F.lit("x").alias("provider_name"))
    src = spark.range(1000).select(F.col("id").cast("string").alias("provider_id"),
                                   F.concat(F.lit("P"), F.col("id").cast("string")).alias("provider_name"))
    ev.createOrReplaceTempView("sk_ev")
    dim.createOrReplaceTempView("sk_dim")
    src.createOrReplaceTempView("sk_src")
    yield ev, dim, src
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Initial Plan ==")[0]


def _largest_task(df, *by) -> int:
    """Rows of the largest partition when dealt out by these columns."""
    return df.repartition(16, *by).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((v is None, v) for v in t))


def test_left_join_hot_key_is_split_and_nulls_are_dealt_out(spark, skewed):
    ev, _, src = skewed
    df = keys.safe_join(ev, src)
    plan = _final_plan(df)
    assert "SortMergeJoin(skew=true)" in plan
    assert _largest_task(ev, "provider_id") > N // 3 > 2 * _largest_task(ev.withColumn("__ls", joins._salt(F.col("provider_id"), ["event_id"]))
                                                                        .filter("provider_id IS NULL"), "provider_id", "__ls")
    expected = spark.sql("""SELECT e.event_id, e.provider_id, p.provider_name FROM sk_ev e LEFT JOIN sk_src p
                            ON e.provider_id = try_cast(try_cast(trim(p.provider_id) AS decimal(38,0)) AS bigint)""")
    assert _sorted(df.collect()) == _sorted(expected.collect())


def test_anti_join_hot_key_is_split(spark, skewed):
    ev, dim, _ = skewed
    df = exclusion.unmatched_providers(ev, dim)
    got = df.collect()
    expected = spark.sql("""SELECT e.event_id, e.provider_id, e.event_type, e.status, e.event_timestamp
                            FROM sk_ev e LEFT ANTI JOIN sk_dim p ON e.provider_id = p.provider_id
                            WHERE e.provider_id IS NOT NULL""")
    assert _sorted(got) == _sorted(expected.collect())
    # (rows with columns of their own: equal bare keys compress to almost nothing, which AQE rightly leaves alone)
    assert "skew=true" in _final_plan(keys.stg_unmatched(ev, dim))
    orphans = exclusion.orphan_events(ev, dim)
    assert orphans.count() == spark.sql(
        "SELECT * FROM sk_ev e WHERE NOT EXISTS (SELECT 1 FROM sk_dim p WHERE p.provider_id = e.provider_id)").count()


def test_not_in_with_a_third_null_keys(spark, skewed):
    ev, dim, _ = skewed
    assert exclusion.not_in_keys(dim, ev).count() == 0
    nn = exclusion.not_in_non_null(dim, ev)
    expected = spark.sql("""SELECT provider_id FROM sk_dim WHERE provider_id NOT IN
                            (SELECT provider_id FROM sk_ev WHERE provider_id IS NOT NULL)""")
    assert _sorted(nn.collect()) == _sorted(expected.collect())


def test_counts_on_hot_keys_match_brute_force(spark, skewed):
    ev, _, src = skewed
    stg = keys.stg_provider(src)
    stg.createOrReplaceTempView("sk_stg")
    expected = spark.sql("""SELECT COUNT(*), COUNT(p.provider_id), COUNT(*) - COUNT(p.provider_id)
                            FROM sk_ev e LEFT JOIN sk_stg p ON e.provider_id = p.provider_id""").collect()[0]
    assert tuple(keys.match_rate(ev, stg).collect()[0]) == tuple(expected)


def test_dedup_of_a_key_holding_a_third_of_rows(spark, skewed):
    ev, _, _ = skewed
    hot = ev.withColumn("event_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("event_id")))
    out = duplicates.dedup_keep_first(hot)
    assert out.count() == N - N // 3 + 1
    kept = out.filter("event_id = -1").collect()
    # the earliest load of the hot key is the row with the largest id among multiples of 3
    assert len(kept) == 1 and kept[0]["event_timestamp"].second == (N - 3) % 60
    assert duplicates.duplicate_keys(hot).collect() == [(-1, N // 3)]
