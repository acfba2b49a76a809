"""Incident 04: join keys of mixed types (INTEGER events vs STRING lookup).

The key is cleaned once, on the lookup side, with the tolerant numeric parse
(``TRY_TO_NUMBER(TRIM(k))``); the event side is never cast row by row. Count
reports pre-aggregate both sides by key before joining, so a hot key costs
one row per side, and the counts are multiplied back to keep the exact
left-join semantics (duplicated lookup keys multiply rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions import normalize_key, to_number_or_null
from freshet.operators.joins import anti_join, left_join


def stg_provider(source: DataFrame, key: str = "provider_id", trim: bool = True) -> DataFrame:
    """The cleaning view -- numeric key (NULL when malformed) and the name."""
    return source.select(normalize_key(key, trim).alias(key), "provider_name")


def normalized_keys(source: DataFrame, key: str = "provider_id") -> DataFrame:
    """K9: raw key beside the normalised key."""
    return source.select(key, normalize_key(key).alias("normalized_provider_id"))


def invalid_keys(source: DataFrame, key: str = "provider_id", trim: bool = True) -> DataFrame:
    """K8 (K7 with ``trim=False``): lookup rows whose key is not a number (NULL keys included)."""
    parsed = normalize_key(key, trim) if trim else to_number_or_null(key)
    return source.filter(parsed.isNull())


def invalid_key_count(source: DataFrame, key: str = "provider_id") -> DataFrame:
    """Number of non-numeric lookup keys."""
    return invalid_keys(source, key).agg(F.count(F.lit(1)).alias("invalid_provider_ids"))


def _string_key(source: DataFrame, key: str) -> DataFrame:
    return source.select(F.col(key).alias("_pk"), F.col("provider_name"))


def naive_type_join(events: DataFrame, source: DataFrame, key: str = "provider_id") -> DataFrame:
    """The faulty inner join, comparing the integer key as text.

    Reproduces the effect of the implicit INTEGER = STRING comparison:
    '104 ' and 'ABC' never match.
    """
    e = events.select("event_id", key, F.col(key).cast("string").alias("_ek"))
    return (e.join(_string_key(source, key), F.col("_ek") == F.col("_pk"), "inner")
             .select("event_id", key, "provider_name"))


def join_row_counts(events: DataFrame, source: DataFrame, key: str = "provider_id") -> DataFrame:
    """Staging row count next to the naive join's row count (one row)."""
    ek = events.groupBy(F.col(key).cast("string").alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    pk = source.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_m"))
    j = ek.join(pk, "_k", "left")
    return j.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("staging_rows"),
                 F.coalesce(F.sum(F.col("_n") * F.coalesce(F.col("_m"), F.lit(0))), F.lit(0))
                  .cast("bigint").alias("joined_rows"))


def naive_unmatched(events: DataFrame, source: DataFrame, key: str = "provider_id") -> DataFrame:
    """Events lost by the naive join, with the (NULL) lookup columns shown."""
    e = events.select("event_id", key, F.col(key).cast("string").alias("_ek"))
    keys = source.select(F.col(key).alias("_k")).distinct()
    lost = anti_join(e, "_ek", keys)
    return lost.select("event_id", key,
                       F.lit(None).cast("string").alias("lookup_provider_id"),
                       F.lit(None).cast("string").alias("provider_name"))


def safe_join(events: DataFrame, source: DataFrame, key: str = "provider_id", trim: bool = True) -> DataFrame:
    """C5 (C4 with ``trim=False``): left join on the cleaned lookup key."""
    right = source.select(normalize_key(key, trim).alias("_pk"), "provider_name")
    return left_join(events.select("event_id", key), key, right, "_pk", ["provider_name"])


def stg_provider_join(events: DataFrame, stg: DataFrame, key: str = "provider_id") -> DataFrame:
    """Left join on the pre-cleaned staging view."""
    right = stg.select(F.col(key).alias("_pk"), "provider_name")
    return left_join(events.select("event_id", key), key, right, "_pk", ["provider_name"])


def stg_unmatched(events: DataFrame, stg: DataFrame, key: str = "provider_id") -> DataFrame:
    """Events with no cleaned lookup match; NULL event keys are included (no guard)."""
    keys = stg.select(F.col(key).alias("_k")).distinct()
    return anti_join(events.select("event_id", key), key, keys)


def match_rate(events: DataFrame, stg: DataFrame, key: str = "provider_id") -> DataFrame:
    """Total, matched (``COUNT(p.k)``) and unmatched events of the left join."""
    ek = events.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    sk = (stg.filter(F.col(key).isNotNull())
             .groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_m")))
    j = ek.join(sk, "_k", "left")
    total = F.coalesce(F.sum(F.col("_n") * F.coalesce(F.col("_m"), F.lit(1))), F.lit(0)).cast("bigint")
    matched = F.coalesce(F.sum(F.col("_n") * F.coalesce(F.col("_m"), F.lit(0))), F.lit(0)).cast("bigint")
    return (j.agg(total.alias("total_events"), matched.alias("matched_events"))
             .withColumn("unmatched_events", F.col("total_events") - F.col("matched_events")))


def key_type_audit(spark, left: DataFrame, right: DataFrame, key: str = "provider_id",
                   left_name: str = "staging_events", right_name: str = "provider_string_source") -> DataFrame:
    """The join key's declared type on both sides (schema metadata, no scan)."""
    lt = left.schema[key].dataType.simpleString()
    rt = right.schema[key].dataType.simpleString()
    rows = [(left_name, key, lt, lt == rt), (right_name, key, rt, lt == rt)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, types_match boolean")


def describe(spark, df: DataFrame) -> DataFrame:
    """``DESCRIBE TABLE`` -- column names and types (schema metadata only)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "col_name string, data_type string, nullable boolean")
