"""Z4 with quarantine: every row with the reasons it breaks the column contracts, accepted and rejected apart.

``contract_report`` counts violations by rule; here the offending rows themselves come out. All row
rules are evaluated in one pass over the events, into an array of reasons a row:

* ``not_null:<key>``, ``not_null:<fk>``: a NULL key or foreign key;
* ``accepted_values:status``: a status outside the accepted ones (a NULL status passes, as in the report);
* ``relationship:<fk>``: a foreign key without a lookup row;
* ``unique:<key>``: every load of a non-NULL key but its first (earliest load; ties by all columns).

One exchange on (key, salt) serves the duplicates; NULL keys are dealt out by a hash of the row. The lookup side
is its distinct keys, joined outer: broadcast by the planner while it is small, else shuffled with skewed keys split.
``write_quarantine`` writes both kinds from a single scan, as partitions of one table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from freshet.operators.controls import ACCEPTED_STATUSES
from freshet.operators.joins import distinct_keys_of, left_join
from freshet.sources import sinks

REASONS = "reasons"
VERDICT = "verdict"
ACCEPTED, REJECTED = "accepted", "rejected"


def with_reasons(events: DataFrame, dim: DataFrame, key: str = "event_id", fk: str = "provider_id", order: str = "loaded_at",
                 accepted: Sequence[str] = ACCEPTED_STATUSES, status: str = "status") -> DataFrame:
    """The events, each once, with ``reasons``: the broken rules in the order above (empty: accepted)."""
    others = [c for c in events.columns if c not in (key, order)]
    salt = F.when(F.col(key).isNull(), F.xxhash64(*events.columns)).otherwise(F.lit(0).cast("bigint"))
    loads = Window.partitionBy(key, "__salt").orderBy(F.asc_nulls_last(order), *[F.asc_nulls_last(c) for c in others])
    rows = events.withColumn("__salt", salt).withColumn("__load", F.row_number().over(loads)).drop("__salt")
    known = distinct_keys_of(dim, fk, "__known").withColumn("__found", F.lit(True))
    rows = left_join(rows, fk, known, "__known", ["__found"])
    rules = [
        (f"not_null:{key}", F.col(key).isNull()),
        (f"not_null:{fk}", F.col(fk).isNull()),
        (f"accepted_values:{status}", F.col(status).isNotNull() & ~F.col(status).isin(list(accepted))),
        (f"relationship:{fk}", F.col(fk).isNotNull() & F.col("__found").isNull()),
        (f"unique:{key}", F.col(key).isNotNull() & (F.col("__load") > 1)),
    ]
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))
    return rows.select(*events.columns, reasons.alias(REASONS))


def rejected_rows(judged: DataFrame) -> DataFrame:
    """The rows with a reason."""
    return judged.filter(F.size(REASONS) > 0)


def accepted_rows(judged: DataFrame) -> DataFrame:
    """The rows without one, as they came."""
    return judged.filter(F.size(REASONS) == 0).drop(REASONS)


def reason_counts(judged: DataFrame) -> DataFrame:
    """Rejected rows by reason (a row with several counts for each)."""
    return judged.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


def write_quarantine(judged: DataFrame, path: str) -> str:
    """Store both kinds of rows in one write; each reader below lists only its own partition."""
    verdict = F.when(F.size(REASONS) > 0, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED))
    return sinks.replace_table(judged.withColumn(VERDICT, verdict), path, partition_by=[VERDICT])


def read_quarantine(spark: SparkSession, path: str, schema: StructType, verdict: str) -> DataFrame:
    """The stored accepted or rejected rows (``schema``: that of the events); accepted ones without reasons."""
    shape = StructType([*schema.fields, StructField(REASONS, ArrayType(StringType())), StructField(VERDICT, StringType())])
    sinks.recover_table(spark, path)
    rows = spark.read.schema(shape).parquet(path).filter(F.col(VERDICT) == F.lit(verdict)).drop(VERDICT)
    return rows.drop(REASONS) if verdict == ACCEPTED else rows
