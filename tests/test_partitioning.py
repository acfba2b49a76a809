"""Date-partitioned storage: the look-back and watermark bounds prune partitions."""

from __future__ import annotations

import os
import re

from freshet.operators import usage
from freshet.sources import sinks
from freshet.sources import tables as T
from freshet.streaming import incremental
from tests.helpers import plan_text, rows

SF = "/root/testdata/sf0.001"
ASOF = "2024-01-31 00:00:00"


def test_lookback_prunes_date_partitions(spark, scratch):
    path = os.path.join(scratch, "query_history")
    sinks.write_date_partitioned(T.query_history(spark, SF), path, "start_time", "start_date")
    stored = spark.read.parquet(path)
    pruned = usage.expensive_queries(stored, ASOF, date_col="start_date")
    plan = plan_text(pruned)
    assert re.search(r"PartitionFilters: \[[^\]]*start_date[^\]]*>= 2024-01-30", plan)
    assert rows(pruned.drop("start_date")) == rows(usage.expensive_queries(T.query_history(spark, SF), ASOF))
    assert rows(usage.daily_query_volume(stored, ASOF, date_col="start_date")) == \
        rows(usage.daily_query_volume(T.query_history(spark, SF), ASOF))


def test_watermark_prunes_date_partitions(spark, scratch):
    path = os.path.join(scratch, "staging")
    sinks.write_date_partitioned(T.staging_events(spark, SF), path, "event_timestamp", "event_date")
    stored = spark.read.parquet(path)
    control = T.pipeline_control(spark)
    batch = incremental.incremental_by_control(stored, control, "EVENT_PIPELINE", date_col="event_date")
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>= 2024-01-29", plan_text(batch))
    plain = incremental.incremental_by_control(T.source_events(spark, SF), control, "EVENT_PIPELINE")
    assert sorted(rows(batch.drop("event_date"))) == sorted(rows(plain))
