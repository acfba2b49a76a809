"""Readers of stored tables and logs with their declared schemas.

A stored table is checked against its declaration before anything is read: a
missing column or another type is an error that names every difference, from
the file footers alone. Columns beyond the declaration are pruned in the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.sources.schemas import SCHEMAS


class SchemaMismatch(ValueError):
    """A stored table doesn't have the declared columns."""


def read_declared(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path`` as declared under ``name``; a mismatch is an error."""
    declared = SCHEMAS[name]
    df = spark.read.format(fmt).load(path)
    stored = {f.name.lower(): f for f in df.schema}
    wrong = [f"{f.name} is missing" for f in declared if f.name not in stored]
    wrong += [f"{f.name} is {stored[f.name].dataType.simpleString()}, declared {f.dataType.simpleString()}"
              for f in declared if f.name in stored and stored[f.name].dataType != f.dataType]
    if wrong:
        raise SchemaMismatch(f"{name} at {path}: {'; '.join(wrong)}")
    return df.select(*[df[stored[f.name].name].alias(f.name) for f in declared])


def read_query_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A10: a stored query log."""
    return read_declared(spark, path, "query_history", fmt)


def read_metering(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored warehouse metering log."""
    return read_declared(spark, path, "warehouse_metering_history", fmt)


def read_load_audit(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A12's input: a stored load audit."""
    return read_declared(spark, path, "load_audit", fmt)
