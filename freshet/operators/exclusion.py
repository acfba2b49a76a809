"""Incident 02: NULL keys and exclusion joins (NOT IN vs NOT EXISTS).

Spark plans ``x NOT IN (subquery)`` as a null-aware anti join that always
broadcasts the subquery side -- here the *event* table, which grows with the
data. ``not_in_keys`` rebuilds the exact three-valued semantics from pieces
that scale: one aggregate by event key (partial, so hot keys collapse
map-side), a one-row flag aggregate over it used as a scalar subquery (no
broadcast of data, no join), and an ordinary anti join that the planner may
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.joins import anti_join, attach_scalars, distinct_keys_of, listing

EVENT_COLUMNS = ["event_id", "provider_id", "event_type", "status", "event_timestamp", "loaded_at"]


def null_key_records(events: DataFrame, key: str = "provider_id") -> DataFrame:
    """B2: events with a NULL key, newest load first."""
    return listing(events.filter(F.col(key).isNull()).select(*EVENT_COLUMNS), "event_id",
                   F.desc_nulls_last("loaded_at"), F.asc_nulls_last("event_id"))


def null_key_count(events: DataFrame, key: str = "provider_id", alias: str = "null_provider_ids") -> DataFrame:
    """Number of events with a NULL key (the filter reaches the scan)."""
    return events.filter(F.col(key).isNull()).agg(F.count(F.lit(1)).alias(alias))


def distinct_keys(events: DataFrame, key: str = "provider_id") -> DataFrame:
    """``SELECT DISTINCT key ORDER BY key`` (NULL included, sorted last)."""
    return events.select(key).distinct().orderBy(F.asc_nulls_last(key))


def unmatched_providers(events: DataFrame, dim: DataFrame, key: str = "provider_id") -> DataFrame:
    """Events whose non-NULL key is missing from the lookup, newest event first."""
    cols = ["event_id", key, "event_type", "status", "event_timestamp"]
    rows = anti_join(events.select(*cols), key, distinct_keys_of(dim, key), keep_null_left=False)
    return listing(rows, "event_id", F.desc_nulls_last("event_timestamp"), F.asc_nulls_last("event_id"))


def missing_keys(dim: DataFrame, events: DataFrame, key: str = "provider_id", bucketed: bool = False) -> DataFrame:
    """Lookup keys with no event (``NOT EXISTS``); a NULL lookup key is kept.

    ``bucketed``: both tables are stored bucketed by the key, nothing is shuffled.
    """
    return anti_join(dim.select(key), key, distinct_keys_of(events, key), bucketed=bucketed)


def orphan_events(events: DataFrame, dim: DataFrame, key: str = "provider_id") -> DataFrame:
    """Event keys with no lookup row (``NOT EXISTS``); NULL keys are returned."""
    return anti_join(events.select(key, "event_id"), key, distinct_keys_of(dim, key), spread=["event_id"]).select(key)


def _keyed(events: DataFrame, key: str) -> DataFrame:
    """One row per event key, the NULL key included, with its row count: the only pass over the events."""
    return events.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))


def _flags(keyed: DataFrame) -> DataFrame:
    """One row: inner row count and inner rows whose key is NULL, from the keyed aggregate."""
    return keyed.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_inner_rows"),
                     F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).alias("_null_rows"))


def _without(dim: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """Outer keys that no inner key equals (NULL never does).

    The keys are compared as one-field structs, which may hold NULL: the optimizer then adds no
    NOT NULL filter below the keyed aggregate, so the join and the flags share its exchange
    and the events are read once.
    """
    # the count is tested, always true, so that column pruning leaves both uses the same aggregate
    inner = keyed.filter(F.col("_n") > 0).select(F.struct(F.col("_k").alias("k")).alias("_inner"))
    outer = F.struct(F.col(key).alias("k"))
    return dim.select(key).join(inner, (outer == F.col("_inner")) & F.col(key).isNotNull(), "left_anti")


def not_in_keys(dim: DataFrame, events: DataFrame, key: str = "provider_id") -> DataFrame:
    """C11: ``dim.key NOT IN (SELECT key FROM events)``.

    Exact three-valued semantics: an empty subquery keeps every row (NULL
    outer keys too); otherwise a NULL outer key, or any NULL in the
    subquery, makes the predicate UNKNOWN and the row is dropped. The flags and
    the anti join read the same keyed aggregate, whose exchange Spark reuses.
    """
    keyed = _keyed(events, key)
    candidates = attach_scalars(_without(dim, keyed, key), _flags(keyed))
    return candidates.filter((F.col("_inner_rows") == 0)
                             | ((F.col("_null_rows") == 0) & F.col(key).isNotNull())).select(key)


def not_in_non_null(dim: DataFrame, events: DataFrame, key: str = "provider_id") -> DataFrame:
    """``NOT IN (SELECT key FROM events WHERE key IS NOT NULL)``."""
    return not_in_keys(dim, events.filter(F.col(key).isNotNull()), key)


def exclusion_comparison(dim: DataFrame, events: DataFrame, key: str = "provider_id") -> DataFrame:
    """One row -- NOT IN count, NOT EXISTS count and NULL-key count side by side.

    The anti join is shared by both exclusions; the NULL count comes from the
    same keyed aggregate that decides the NOT IN semantics.
    """
    keyed = _keyed(events, key)
    cand = _without(dim, keyed, key).agg(F.count(F.lit(1)).alias("not_exists_count"),
                                         F.count_if(F.col(key).isNotNull()).alias("_cand_non_null"))
    return (attach_scalars(cand, _flags(keyed))
                .select(F.when(F.col("_inner_rows") == 0, F.col("not_exists_count"))
                         .when(F.col("_null_rows") > 0, F.lit(0).cast("bigint"))
                         .otherwise(F.col("_cand_non_null")).alias("not_in_count"),
                        F.col("not_exists_count"),
                        F.col("_null_rows").alias("null_provider_ids")))
