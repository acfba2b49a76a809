"""Prevention controls named in the incident reports, as table-to-table Spark jobs.

Each control is a plain ``DataFrame -> DataFrame`` function whose thresholds
are parameters. Calendar checks generate days from a one-row min/max
aggregate (bounded by the date span, not the row count); windowed checks run
over per-day aggregates partitioned by warehouse or month, never over raw
rows and never in a single unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions import asof_or_now, at_or_after, in_lookback, since
from freshet.operators.duplicates import dedup_keep_first
from freshet.operators.joins import anti_join, attach_scalars, distinct_keys_of, listing
from freshet.operators.keys import invalid_keys, match_rate

# Event statuses the contract accepts, and the quota levels.
ACCEPTED_STATUSES = ("APPROVED", "COMPLETE", "DENIED")
QUOTA_CREDITS = 100
QUOTA_LEVELS = (75, 90, 100)


def batch_id(ts: str = "loaded_at", prefix: str = "batch_") -> Column:
    """Daily load-batch identifier, e.g. ``batch_2024-01-13``."""
    return F.concat(F.lit(prefix), F.to_date(ts).cast("string"))


def idempotent_batch_load(incoming: DataFrame, audit: DataFrame, batch: Column | None = None,
                          audit_col: str = "file_name") -> DataFrame:
    """The incoming rows whose batch is not yet in the load audit (safe to append).

    Each batch id covers a whole load (a day's rows). The audit's ids are one row
    per batch: under the planner's byte threshold they are broadcast and incoming rows
    stay where they are; beyond it the join is shuffled and AQE splits the hot batches.
    """
    inc = incoming.withColumn("batch_id", batch if batch is not None else batch_id())
    return anti_join(inc, "batch_id", distinct_keys_of(audit, audit_col))


def merge_upsert(target: DataFrame, incoming: DataFrame, key: str = "event_id",
                 order: str = "loaded_at", tie_breakers: Sequence[str] | None = None,
                 date_col: str | None = None) -> DataFrame:
    """MERGE-style ingestion -- incoming rows win, one (latest) row per key.

    Target rows whose key is in the incoming batch are replaced by the latest
    incoming version; incoming rows with a NULL key match nothing and are
    inserted as they are. With ``date_col`` (a date partition column of both sides that a
    key never changes) only the target's partitions from the batch's first to its last
    date are read, and the one of the rows without a date if the batch holds such rows;
    the result is those partitions' new content, to be stored with ``sinks.replace_partitions``.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in incoming.columns if c not in (key, order)]
    # one pass over the batch: NULL keys are dealt out by a hash and all kept
    salt = F.when(F.col(key).isNull(), F.xxhash64(*incoming.columns)).otherwise(F.lit(0).cast("bigint"))
    best = (Window.partitionBy(key, "_salt")
            .orderBy(F.desc_nulls_last(order), *[F.asc_nulls_last(c) for c in tie_breakers]))
    latest = (incoming.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(best))
              .filter((F.col("_rn") == 1) | F.col(key).isNull()).drop("_salt", "_rn"))
    if date_col:
        undated = F.col(date_col).isNull()
        lo, hi, some_undated = incoming.agg(F.min(date_col), F.max(date_col), F.bool_or(undated)).first()
        touched = F.col(date_col).between(F.lit(lo), F.lit(hi)) if lo is not None else F.lit(False)
        target = target.filter(touched | undated if some_undated else touched)
    kept = anti_join(target, key, distinct_keys_of(incoming, key))
    return kept.unionByName(latest)


def load_audit_report(events: DataFrame, table_name: str = "STAGING_EVENTS",
                      key: str = "event_id", ts: str = "loaded_at") -> DataFrame:
    """Z3: one audit row per daily load batch -- rows, distinct keys, duplicates, first/last load.

    Two-level aggregation: per (batch, key) first, with map-side combine, then
    per batch over those groups. The distinct-key count needs no ``Expand``
    of the input, and a batch holding a third of all rows is spread over its
    keys in the first shuffle.
    """
    per_key = (events.groupBy(batch_id(ts).alias("file_name"), F.col(key).alias("_key"))
                     .agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last")))
    return (per_key.groupBy("file_name")
                   .agg(F.sum("_n").cast("bigint").alias("row_count"),
                        F.count("_key").alias("distinct_events"),
                        F.min("_first").alias("first_load_time"),
                        F.max("_last").alias("last_load_time"))
                   .select("file_name", F.lit(table_name).alias("table_name"), "row_count", "distinct_events",
                           (F.col("row_count") - F.col("distinct_events")).alias("duplicate_rows"),
                           "first_load_time", "last_load_time"))


def _stack(row: DataFrame, entries: list[tuple[str, str, str]]) -> DataFrame:
    """Turn a one-row frame of metrics into one row per (rule, column, metric column)."""
    parts = ", ".join(f"'{r}', '{c}', CAST({m} AS BIGINT)" for r, c, m in entries)
    return row.selectExpr(f"stack({len(entries)}, {parts}) AS (rule, column_name, violations)")


def contract_report(events: DataFrame, dim: DataFrame, string_source: DataFrame | None = None,
                    key: str = "event_id", fk: str = "provider_id",
                    accepted: Sequence[str] = ACCEPTED_STATUSES) -> DataFrame:
    """Column contracts -- unique, not-null, accepted values, relationship, key type.

    One row per rule with its violation count. Uniqueness, not-null and
    accepted values come from one keyed aggregate (partial aggregation first);
    the relationship rule is an anti join against the de-duplicated lookup
    keys; the type rule reads schema metadata only.
    """
    # one keyed pass: uniqueness, both not-null rules and accepted values
    per_key = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(fk).isNull()).alias("_fk_null_rows"),
        F.count_if(F.col("status").isNotNull() & ~F.col("status").isin(list(accepted))).alias("_bad_rows"))
    basic = per_key.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("_key_nulls"),
        F.coalesce(F.sum("_fk_null_rows"), F.lit(0)).alias("_fk_nulls"),
        F.coalesce(F.sum("_bad_rows"), F.lit(0)).alias("_bad_status"),
        F.count_if(F.col("_n") > 1).alias("_dup_keys"))
    orphans = (anti_join(events.select(fk), fk, distinct_keys_of(dim, fk), keep_null_left=False)
               .agg(F.count(F.lit(1)).alias("_orphans")))
    type_mismatch = 0
    if string_source is not None:
        type_mismatch = int(events.schema[fk].dataType != string_source.schema[fk].dataType)
    row = (attach_scalars(basic, orphans)
                .withColumn("_type_mismatch", F.lit(type_mismatch)))
    out = _stack(row, [("unique", key, "_dup_keys"),
                       ("not_null", key, "_key_nulls"),
                       ("not_null", fk, "_fk_nulls"),
                       ("accepted_values", "status", "_bad_status"),
                       ("relationship", fk, "_orphans"),
                       ("same_type", fk, "_type_mismatch")])
    return out.withColumn("passed", F.col("violations") == 0)


def missing_load_days(audit: DataFrame, ts: str = "last_load_time") -> DataFrame:
    """Calendar days between the first and last load with no load at all."""
    days = audit.select(F.to_date(ts).alias("load_date")).filter(F.col("load_date").isNotNull()).distinct()
    calendar = (days.agg(F.min("load_date").alias("lo"), F.max("load_date").alias("hi"))
                    .filter(F.col("lo").isNotNull())
                    .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("missing_date")))
    return anti_join(calendar, "missing_date", days, "load_date", keep_null_left=False).orderBy("missing_date")


def missing_load_spans(audit: DataFrame, asof=None, ts: str = "last_load_time", table: str = "table_name") -> DataFrame:
    """Z5 by table: every run of days without a load between two loads, and the open one up to ``asof``.

    Gaps and islands over the distinct loaded days of each table: a day's successor is the next loaded
    day, or the day after ``asof`` for the last one (the heartbeat); where they are more than a day
    apart, the days between are a span. No calendar is generated, so a table that was quiet for years costs
    one row. ``is_open``: the span reaches to ``asof``, nothing was loaded since. Loads after ``asof`` and
    rows without a load time are left out; a table with no load at all has no span.
    """
    today = F.to_date(asof_or_now(asof))
    days = audit.select(F.col(table).alias("table_name"), F.to_date(ts).alias("_day")).filter(F.col("_day") <= today).distinct()
    following = F.lead("_day").over(Window.partitionBy("table_name").orderBy("_day"))
    spans = days.withColumn("_next", following).withColumn("is_open", F.col("_next").isNull())
    spans = spans.withColumn("_next", F.coalesce("_next", F.date_add(today, 1)))
    return (spans.filter(F.datediff("_next", "_day") > 1)
                 .select("table_name", F.date_add("_day", 1).alias("first_missing"), F.date_sub("_next", 1).alias("last_missing"),
                         (F.datediff("_next", "_day") - 1).alias("missing_days"), "is_open")
                 .orderBy(F.asc_nulls_last("table_name"), "first_missing"))


def missing_files(expected: DataFrame, audit: DataFrame, col: str = "file_name",
                  audit_col: str = "file_name") -> DataFrame:
    """Expected files (or batches) that the load audit never recorded."""
    names = expected.select(F.col(col).alias("file_name")).filter(F.col("file_name").isNotNull()).distinct()
    return anti_join(names, "file_name", distinct_keys_of(audit, audit_col), keep_null_left=False).orderBy("file_name")


def _from_midnight(df: DataFrame, ts: str, asof, days: int | None, extra: int, date_col: str | None) -> DataFrame:
    """Rows since midnight ``days + extra`` days before ``asof`` (all rows when ``days`` is None)."""
    if days is None:
        return df
    return df.filter(at_or_after(ts, F.to_date(since(asof, days + extra, "day")).cast("timestamp_ntz"), date_col))


def row_growth(events: DataFrame, ts: str = "loaded_at", asof=None, days: int | None = None,
               date_col: str | None = None) -> DataFrame:
    """Rows per day against the previous calendar day (NULL when that day had none).

    With ``days`` only the last days before ``asof`` are reported, and one more day is
    read; rows without a load time form a day of their own, with no prior day, and
    are outside any look-back.

    One pass: the daily counts are computed once, and each day's count is
    also emitted as the "prior" count of the next calendar day; a second
    aggregate over these (days x 2) rows lines them up. No self-join (which
    would scan the input twice) and no unpartitioned window.
    """
    recent = _from_midnight(events, ts, asof, days, 1, date_col)
    daily = recent.groupBy(F.to_date(ts).alias("load_date")).agg(F.count(F.lit(1)).alias("_n"))
    out = _growth(daily)
    if days is not None:
        out = out.filter(F.col("load_date") >= F.to_date(since(asof, days, "day")))
    return out.orderBy(F.asc_nulls_last("load_date"))


def _growth(daily: DataFrame) -> DataFrame:
    """Daily counts (load_date, _n) beside those of the calendar day before."""
    today = F.struct(F.col("load_date").alias("d"), F.col("_n").alias("cur"), F.lit(None).cast("bigint").alias("prev"))
    next_day = F.struct(F.date_add("load_date", 1).alias("d"), F.lit(None).cast("bigint").alias("cur"),
                        F.col("_n").alias("prev"))
    both = F.when(F.col("load_date").isNull(), F.array(today)).otherwise(F.array(today, next_day))
    pairs = daily.select(F.explode(both).alias("p")).select("p.*")
    lined = (pairs.groupBy(F.col("d").alias("load_date"))
                  .agg(F.max("cur").alias("row_count"), F.max("prev").alias("prior_row_count"))
                  .filter(F.col("row_count").isNotNull()))
    change = F.col("row_count") - F.col("prior_row_count")
    return lined.select("load_date", "row_count", "prior_row_count", change.alias("row_change"),
                        (change.cast("double") / F.col("prior_row_count")).alias("change_ratio"))


def unmatched_rate(events: DataFrame, stg: DataFrame, key: str = "provider_id",
                   threshold: float = 0.05) -> DataFrame:
    """The join-quality counts plus the unmatched rate and a threshold breach flag."""
    m = match_rate(events, stg, key)
    rate = F.when(F.col("total_events") > 0, F.col("unmatched_events").cast("double") / F.col("total_events"))
    return (m.withColumn("unmatched_rate", rate)
             .withColumn("breach", F.coalesce(F.col("unmatched_rate") > F.lit(threshold), F.lit(False))))


def daily_anomalies(df: DataFrame, ts: str, group: str, value: str, factor: float = 2.0,
                    window_days: int = 7, date_alias: str = "usage_date",
                    value_alias: str = "daily_total", asof=None, days: int | None = None,
                    date_col: str | None = None) -> DataFrame:
    """Each day's total against the mean of the previous ``window_days`` calendar days.

    The daily totals are exact sums; the look-back is a range frame over the
    day number, partitioned by ``group``, so only per-day aggregates are
    windowed. A day is anomalous when it exceeds ``factor`` times the mean.
    With ``days`` only the last days before ``asof`` are reported and only
    ``window_days`` more are read (``date_col``: a date partition column to prune by).
    """
    daily = _from_midnight(df, ts, asof, days, window_days, date_col).groupBy(F.to_date(ts).alias(date_alias), group).agg(F.sum(value).alias("_total"))
    w = (Window.partitionBy(group)
               .orderBy(F.unix_date(F.col(date_alias)))
               .rangeBetween(-window_days, -1))
    prior_sum = F.sum("_total").over(w)
    prior_days = F.count("_total").over(w)
    out = daily.select(date_alias, group, F.col("_total").cast("double").alias(value_alias),
                       prior_days.alias("prior_days"), prior_sum.alias("_prior_sum"))
    avg = F.when(F.col("prior_days") > 0, F.col("_prior_sum").cast("double") / F.col("prior_days"))
    if days is not None:
        out = out.filter(F.col(date_alias) >= F.to_date(since(asof, days, "day")))
    return (out.withColumn("prior_avg", avg)
               .withColumn("is_anomaly", F.coalesce(F.col(value_alias) > F.lit(factor) * F.col("prior_avg"),
                                                    F.lit(False)))
               .drop("_prior_sum")
               .orderBy(date_alias, group))


def usage_anomalies(metering: DataFrame, factor: float = 2.0, window_days: int = 7, asof=None,
                    days: int | None = None, date_col: str | None = None) -> DataFrame:
    """Daily credits per warehouse vs the prior week."""
    return daily_anomalies(metering, "start_time", "warehouse_name", "credits_used", factor, window_days,
                           "usage_date", "credits_used", asof, days, date_col)


def bytes_anomalies(history: DataFrame, factor: float = 2.0, window_days: int = 7, asof=None,
                    days: int | None = None, date_col: str | None = None) -> DataFrame:
    """Daily bytes scanned per warehouse vs the prior week (unusual-bytes alert)."""
    return daily_anomalies(history, "start_time", "warehouse_name", "bytes_scanned", factor, window_days,
                           "run_date", "bytes_scanned", asof, days, date_col)


def credit_quota_status(metering: DataFrame, quota: float = QUOTA_CREDITS,
                        levels: Sequence[int] = QUOTA_LEVELS, asof=None, days: int | None = None,
                        date_col: str | None = None) -> DataFrame:
    """Month-to-date credits per warehouse and day, with the quota level reached.

    Levels (percent of the monthly quota): the highest level reached is
    reported; reaching the last level means SUSPEND, the others NOTIFY. With
    ``days`` only the last days before ``asof`` are reported, and the log is
    read from the first of their first month.
    """
    recent = metering
    if days is not None:
        first = F.trunc(F.to_date(since(asof, days, "day")), "month").cast("timestamp_ntz")
        recent = metering.filter(at_or_after("start_time", first, date_col))
    daily = (recent.groupBy(F.to_date("start_time").alias("usage_date"), "warehouse_name")
                     .agg(F.sum("credits_used").alias("_credits"))
                     .withColumn("usage_month", F.trunc("usage_date", "month")))
    w = (Window.partitionBy("warehouse_name", "usage_month").orderBy("usage_date")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = daily.select("usage_month", "usage_date", "warehouse_name",
                       F.col("_credits").cast("double").alias("credits_used"),
                       F.sum("_credits").over(w).cast("double").alias("month_to_date_credits"))
    if days is not None:
        out = out.filter(F.col("usage_date") >= F.to_date(since(asof, days, "day")))
    pct = F.col("month_to_date_credits") * F.lit(100.0) / F.lit(float(quota))
    out = out.withColumn("quota_used_pct", pct)
    lv = sorted(levels)
    level = F.lit(0)
    for v in lv:
        level = F.when(F.col("quota_used_pct") >= F.lit(float(v)), F.lit(v)).otherwise(level)
    out = out.withColumn("quota_level", level)
    action = (F.when(F.col("quota_level") >= F.lit(lv[-1]), F.lit("SUSPEND"))
               .when(F.col("quota_level") > 0, F.lit("NOTIFY"))
               .otherwise(F.lit("NONE")))
    return out.withColumn("quota_action", action).orderBy("usage_date", "warehouse_name")


def long_running_queries(history: DataFrame, max_seconds: float = 300, asof=None, days: int | None = None,
                         date_col: str | None = None) -> DataFrame:
    """Queries that ran longer than the runtime limit (in the last ``days``), longest first."""
    if days is not None:
        history = history.filter(in_lookback("start_time", asof, days, "day", date_col))
    slow = (history.filter(F.col("total_elapsed_time") > F.lit(max_seconds * 1000))
                   .select("query_id", "user_name", "warehouse_name", "start_time", "total_elapsed_time"))
    return listing(slow, "query_id", F.desc("total_elapsed_time"), "query_id")


def incident_checklist(staging: DataFrame, curated: DataFrame, audit: DataFrame, string_source: DataFrame, metering: DataFrame, asof=None,
                       sla_hours: int = 24, growth_band: tuple[float, float] = (0.5, 2.0)) -> DataFrame:
    """The troubleshooting checklist, one row per answerable question.

    Columns: check_no, check_name, metric (double), passed (boolean). Every
    metric is a one-row aggregate; they are combined as scalar subqueries
    and stacked, so the plan has no join and no wide intermediate. Staging is read once:
    the daily counts and the keyed pass share one aggregate by key and load day. The
    metering log is read from a window before the reported day on.
    """
    missing = missing_load_days(audit).agg(F.count(F.lit(1)).cast("double").alias("m2"))
    by_key_day = staging.groupBy("event_id", F.to_date("loaded_at").alias("load_date")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("provider_id").isNull()).alias("_nulls"),
        F.max("loaded_at").alias("_latest"))
    daily = by_key_day.groupBy("load_date").agg(F.sum("_n").alias("_n"))
    growth = (_growth(daily).filter(F.col("prior_row_count").isNotNull())
              .agg(F.max_by("row_count", "load_date").alias("_r"), F.max_by("prior_row_count", "load_date").alias("_p"))
              .select((F.col("_r").cast("double") / F.col("_p")).alias("m4")))
    # the keyed pass answers questions 1, 3, 5, 6 and 8
    per_key = by_key_day.groupBy("event_id").agg(F.sum("_n").alias("_n"), F.sum("_nulls").alias("_nulls"),
                                                 F.max("_latest").alias("_key_latest"))
    keys_ = per_key.agg(F.count_if(F.col("_n") > 1).cast("double").alias("m5"),
                        F.coalesce(F.sum("_nulls"), F.lit(0)).cast("double").alias("m6"),
                        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("double").alias("m8"),
                        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
                        F.max("_key_latest").alias("_latest"))
    keys_ = keys_.withColumn(
        "m3", F.when(F.col("_latest").isNull(), F.lit(None).cast("double"))
               .otherwise((F.unix_micros(asof_or_now(asof).cast("timestamp"))
                           - F.unix_micros(F.col("_latest").cast("timestamp"))) / F.lit(3.6e9)))
    invalid = invalid_keys(string_source).agg(F.count(F.lit(1)).cast("double").alias("m7"))
    grain = curated.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("_curated_sum"),
                        F.count(F.lit(1)).alias("_groups"),
                        F.count_distinct(F.struct("event_date", "event_type", "status")).alias("_distinct_groups"))
    anomalies = (usage_anomalies(metering, asof=asof, days=1)
                 .agg(F.count_if(F.col("is_anomaly")).cast("double").alias("m10")))
    # every input is a global aggregate: exactly one row each, even when empty
    row = attach_scalars(keys_, missing, growth, invalid, grain, anomalies)
    row = row.withColumn("m1", F.when(F.col("_latest").isNull(), F.lit(0.0)).otherwise(F.lit(1.0)))
    row = row.withColumn("m9", (F.col("_curated_sum") - F.col("_rows")).cast("double")
                         + (F.col("_groups") - F.col("_distinct_groups")).cast("double"))
    lo, hi = growth_band
    checks = [
        (1, "pipeline_ran", "m1", "m1 = 1"),
        (2, "source_arrived", "m2", "m2 = 0"),
        (3, "data_fresh", "m3", f"m3 IS NOT NULL AND m3 <= {float(sla_hours)}"),
        (4, "row_count_reasonable", "m4", f"m4 IS NULL OR (m4 >= {lo} AND m4 <= {hi})"),
        (5, "keys_unique", "m5", "m5 = 0"),
        (6, "no_null_keys", "m6", "m6 = 0"),
        (7, "join_key_types_compatible", "m7", "m7 = 0"),
        (8, "no_reprocessing", "m8", "m8 = 0"),
        (9, "expected_grain", "m9", "m9 = 0"),
        (10, "usage_stable", "m10", "m10 = 0"),
    ]
    parts = ", ".join(f"{n}, '{name}', CAST({m} AS DOUBLE), COALESCE({cond}, false)" for n, name, m, cond in checks)
    return row.selectExpr(f"stack({len(checks)}, {parts}) AS (check_no, check_name, metric, passed)")
