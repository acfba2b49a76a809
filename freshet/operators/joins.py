"""Join building blocks that stay balanced when keys are NULL or hot.

* NULL keys never match an equi-join, but they all hash to the same shuffle
  partition. At scale a NULL-heavy key (say a third of all rows) would land
  in one task. The helpers add a salt to the join key: a hash of the row where
  the key is NULL, zero otherwise and on the other side. NULL rows then spread over
  all tasks, and the left side is read once. The salt is a function of the row
  (no ``rand``), so a recomputed task deals its rows as before.
* Hot non-NULL keys on the streamed (left) side are split by AQE's skew-join
  handling (enabled in ``freshet.session``); the build side of every anti
  join is a de-duplicated key set, so a hot key there is collapsed by the
  partial aggregate before it is shuffled.
* No join here forces a broadcast: the planner broadcasts only when the
  estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks
  measured sizes at runtime) and falls back to a shuffled join otherwise.
  One-row aggregates are combined with ``attach_scalars`` (scalar subqueries),
  never with a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_scalars(df: DataFrame, *one_row: DataFrame) -> DataFrame:
    """Add the columns of one-row aggregates to ``df`` as scalar subqueries.

    Each argument must be a global aggregate (exactly one row). No join is
    planned: each aggregate is one struct-valued subquery, evaluated once however
    many of its columns are used, and substituted as a literal.
    """
    extra = []
    for agg in one_row:
        row = agg.select(F.struct(*agg.columns).alias("_row")).scalar()
        extra += [row[c].alias(c) for c in agg.columns]
    return df.select("*", *extra)


def distinct_keys_of(df: DataFrame, key: Column | str, alias: str = "_k", keep_null: bool = False) -> DataFrame:
    """The de-duplicated key set of ``df`` (partial aggregation before the shuffle)."""
    k = F.col(key) if isinstance(key, str) else key
    keys = df.select(k.alias(alias))
    if not keep_null:
        keys = keys.filter(F.col(alias).isNotNull())
    return keys.distinct()


def _salt(key: Column, row: list[str]) -> Column:
    """0 for a key; for a NULL key a hash of the row, which deals such rows to all tasks."""
    return F.when(key.isNull(), F.xxhash64(*row)).otherwise(F.lit(0).cast("bigint"))


def _no_salt(key: Column) -> Column:
    # always 0, but not a constant to the optimizer, which would drop it from the join key
    return F.pmod(F.xxhash64(key), F.lit(1).cast("bigint"))


def anti_join(left: DataFrame, left_key: str, right_keys: DataFrame, right_key: str = "_k",
              keep_null_left: bool = True, spread: list[str] | None = None, bucketed: bool = False) -> DataFrame:
    """Rows of ``left`` whose key has no equal in ``right_keys`` (NOT EXISTS).

    A NULL left key never has an equal, so those rows are kept (or dropped
    with ``keep_null_left=False``). ``spread``: the columns whose hash deals them
    out (all columns by default). ``bucketed``: both sides are stored bucketed by the key
    (``sinks.write_bucketed``); no salt is added then, so the join runs bucket by bucket without a shuffle.
    """
    rk = right_keys.select(F.col(right_key).alias("__rk")).filter(F.col("__rk").isNotNull())
    lk = F.col(left_key)
    if not keep_null_left:
        return left.filter(lk.isNotNull()).join(rk, lk == F.col("__rk"), "left_anti")
    if bucketed:
        return left.join(rk, lk == F.col("__rk"), "left_anti")
    salted = left.withColumn("__ls", _salt(lk, spread or left.columns))
    rk = rk.withColumn("__rs", _no_salt(F.col("__rk")))
    return salted.join(rk, (lk == F.col("__rk")) & (F.col("__ls") == F.col("__rs")), "left_anti").drop("__ls")


def left_join(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
              right_cols: list[str], spread: list[str] | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left.k = right.k``, projecting ``right_cols``.

    ``right`` must already carry its join key in column ``right_key`` (which
    must not clash with ``left``'s columns). NULL-key rows of ``left`` get NULL right columns.
    """
    lk = F.col(left_key)
    salted = left.withColumn("__ls", _salt(lk, spread or left.columns))
    r = (right.select(F.col(right_key), *[F.col(c) for c in right_cols]).filter(F.col(right_key).isNotNull())
              .withColumn("__rs", _no_salt(F.col(right_key))))
    return (salted.join(r, (lk == F.col(right_key)) & (F.col("__ls") == F.col("__rs")), "left")
                  .drop(right_key, "__ls", "__rs"))


def listing(df: DataFrame, by: str, *order: Column) -> DataFrame:
    """A globally sorted row-level listing whose source is read once.

    A global sort samples its input to find range bounds, which runs the scans and joins
    below it twice. One exchange in between lets the sampling and the sort both
    read the shuffled rows.
    """
    return df.repartition(by).orderBy(*order)
