"""The raw-data explorer: newest-n events, facets, multi-select filter, helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.exclusion import EVENT_COLUMNS

# Explorer row limit (default, lower and upper clamp).
DEFAULT_LIMIT = 100
MIN_LIMIT = 1
MAX_LIMIT = 1000


def clamp_limit(n) -> int:
    """``max(1, min(int(n), 1000))``."""
    return max(MIN_LIMIT, min(int(n), MAX_LIMIT))


def recent_events(events: DataFrame, n: int = DEFAULT_LIMIT) -> DataFrame:
    """the newest n events by event time (a top-k, not a global sort)."""
    return (events.select(*EVENT_COLUMNS)
                  .orderBy(F.desc_nulls_last("event_timestamp"), F.asc_nulls_last("event_id"))
                  .limit(clamp_limit(n)))


def _isin(col: str, values: Sequence[str]):
    # An empty selection keeps nothing; NULL never matches a selection.
    return F.col(col).isin(list(values)) if values else F.lit(False)


def explorer_filter(events: DataFrame, event_types: Sequence[str], statuses: Sequence[str],
                    n: int = DEFAULT_LIMIT) -> DataFrame:
    """Limit first (newest n), then filter by the selected types and statuses.

    The order of work is the explorer's: the filter applies to the fetched
    rows, so it must not be (and Catalyst does not) push it below the limit.
    """
    return recent_events(events, n).filter(_isin("event_type", event_types) & _isin("status", statuses))


def facet_values(df: DataFrame, cols: Sequence[str] = ("event_type", "status")) -> DataFrame:
    """Distinct non-NULL values of each facet column, sorted.

    One scan: each row is exploded into (facet, value) pairs and de-duplicated
    with a partial aggregate, so the result size is the number of distinct
    values, not rows.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))
                                for c in cols]))
    return (df.select(pairs.alias("_p"))
              .select("_p.facet", "_p.value")
              .filter(F.col("value").isNotNull())
              .distinct()
              .orderBy("facet", "value"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names."""
    return df.toDF(*[c.lower() for c in df.columns])


def select_available(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order."""
    present = set(df.columns)
    return df.select(*[c for c in cols if c in present])
