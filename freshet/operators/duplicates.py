"""Incident 01: duplicate loads -- inject, detect, measure, repair, validate.

Every detector is a group-by on the business key with partial aggregation,
so a key repeated a billion times is reduced map-side before the shuffle.
The repair keeps the first load per key with ``row_number() = 1``; Spark
plans that as a partial ``WindowGroupLimit`` before the exchange (each map
task forwards at most one row per key), so a hot key does not land in one
window task. The ordering always ends in a total tie-breaker, so the kept
row does not depend on task order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def replay_batch(df: DataFrame) -> DataFrame:
    """A4: the same batch loaded twice (every row twice, same ``loaded_at``)."""
    return df.unionAll(df)


def row_count(df: DataFrame, alias: str = "total_rows") -> DataFrame:
    """Global row count."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def _key_counts(df: DataFrame, ks: list[str], count_alias: str, min_count: int) -> DataFrame:
    return (df.groupBy(*ks)
              .agg(F.count(F.lit(1)).alias(count_alias))
              .filter(F.col(count_alias) >= min_count))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str] = "event_id",
                   count_alias: str = "duplicate_count") -> DataFrame:
    """D3: keys that occur more than once, with their count (``HAVING COUNT(*) > 1``), in key order."""
    ks = _keys(keys)
    return _key_counts(df, ks, count_alias, 2).orderBy(*[F.asc_nulls_last(k) for k in ks])


def key_occurrences(df: DataFrame, keys: str | Sequence[str] = "event_id") -> DataFrame:
    """The script's validation step (``HAVING COUNT(*) >= 1``): every key with its count.

    Unordered, as in the script: one row per key is as large as the table's
    key set, so it is not globally sorted.
    """
    return _key_counts(df, _keys(keys), "occurrence_count", 1)


def duplicate_details(df: DataFrame, key: str = "event_id", ts: str = "loaded_at") -> DataFrame:
    """Duplicated keys with count, first and last load; most repeated first."""
    return (df.groupBy(key)
              .agg(F.count(F.lit(1)).alias("duplicate_count"),
                   F.min(ts).alias("first_loaded_at"),
                   F.max(ts).alias("last_loaded_at"))
              .filter(F.col("duplicate_count") > 1)
              .orderBy(F.desc("duplicate_count"), F.asc_nulls_last(key)))


def duplication_extent(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Total rows, distinct keys (exact; NULL not counted) and their difference."""
    return (df.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_distinct(key).alias("unique_events"))
              .withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_events")))


def duplicated_key_count(df: DataFrame, key: str = "event_id", alias: str = "duplicate_event_ids") -> DataFrame:
    """Number of keys that occur more than once."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
              .agg(F.count_if(F.col("_n") > 1).alias(alias)))


def dedup_keep_first(df: DataFrame, keys: str | Sequence[str] = "event_id",
                     order: Sequence[Column | str] = ("loaded_at",),
                     tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Keep the earliest row per key (``QUALIFY ROW_NUMBER() ... = 1``).

    ``order`` columns sort ascending with NULLs last (a row with no load time
    never wins over one that has it). ``tie_breakers`` default to every other
    column, which makes the choice total: fully identical rows are the only
    remaining ties, and any of them is the same row.
    """
    ks = _keys(keys)
    order_cols = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order]
    named = {c for c in order if isinstance(c, str)}
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in ks and c not in named]
    w = Window.partitionBy(*ks).orderBy(*order_cols, *[F.asc_nulls_last(c) for c in tie_breakers])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))
