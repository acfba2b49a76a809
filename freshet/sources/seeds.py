"""A2: the sample seed rows (providers, events, string keys), as small typed DataFrames.

These are test fixtures (golden inputs), never inputs of a registered query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from freshet.sources import schemas

# Sample providers (id, name, specialty).
PROVIDERS = [
    (101, "Provider A", "Cardiology"),
    (102, "Provider B", "Neurology"),
    (103, "Provider C", "Orthopedics"),
    (104, "Provider D", "Primary Care"),
    (105, "Provider E", "Dermatology"),
]

# Sample events (id, provider, type, status, event time).
EVENTS = [
    (1, 101, "AUTHORIZATION", "APPROVED", "2026-07-20 08:30:00"),
    (2, 101, "AUTHORIZATION", "DENIED", "2026-07-20 09:15:00"),
    (3, 102, "CLAIM", "COMPLETE", "2026-07-20 10:00:00"),
    (4, 103, "AUTHORIZATION", "APPROVED", "2026-07-21 11:30:00"),
    (5, 104, "CLAIM", "COMPLETE", "2026-07-21 12:00:00"),
    (6, 101, "CLAIM", "COMPLETE", "2026-07-22 08:00:00"),
    (7, 102, "AUTHORIZATION", "DENIED", "2026-07-22 09:45:00"),
    (8, 103, "CLAIM", "COMPLETE", "2026-07-22 14:20:00"),
    (9, 104, "AUTHORIZATION", "APPROVED", "2026-07-23 07:30:00"),
    (10, 105, "CLAIM", "COMPLETE", "2026-07-23 16:10:00"),
]

# String-typed provider keys, as seeded by the script and as
# listed in the incident report.
STRING_SOURCE_SCRIPT = [("101", "Provider A"), ("102", "Provider B"), ("ABC", "Invalid Provider")]
STRING_SOURCE_REPORT = [("101", "Provider A"), ("102", "Provider B"), ("103", "Provider C"),
                        ("ABC", "Invalid Provider"), ("104 ", "Provider D")]


def ts(s: str | None) -> dt.datetime | None:
    return None if s is None else dt.datetime.fromisoformat(s)


def seed_providers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROVIDERS, schemas.DIM_PROVIDER_LOOKUP)


def seed_events(spark: SparkSession, load_ts: str = "2026-07-24 00:00:00") -> DataFrame:
    """Sample events; ``loaded_at`` takes its default (the load time)."""
    rows = [(i, p, t, s, ts(e), ts(load_ts)) for i, p, t, s, e in EVENTS]
    return spark.createDataFrame(rows, schemas.STAGING_EVENTS)


def seed_string_source(spark: SparkSession, report: bool = False) -> DataFrame:
    rows = STRING_SOURCE_REPORT if report else STRING_SOURCE_SCRIPT
    return spark.createDataFrame(rows, schemas.PROVIDER_STRING_SOURCE)
