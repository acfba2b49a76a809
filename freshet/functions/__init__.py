"""Scalar column helpers (warehouse-dialect semantics as Spark expressions).

All of these return ``Column`` objects built from ``pyspark.sql.functions``,
so they stay inside whole-stage codegen and never cross into Python.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_column", "ntz", "since", "hours_crossed", "minutes_crossed",
    "to_number_or_null", "normalize_key", "freshness_hours_expr", "format_ts",
    "ms_to_seconds", "asof_or_now", "at_or_after", "in_lookback", "NO_LOAD_TEXT",
]

# Fixed value: the dashboard's text for a missing load time.
NO_LOAD_TEXT = "No load found"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: str | _dt.datetime | Column) -> Column:
    """A TIMESTAMP_NTZ literal (naive timestamps are taken to be UTC)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def asof_or_now(asof) -> Column:
    """``asof`` as an NTZ literal; ``None`` means the current time (UTC)."""
    if asof is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return ntz(asof)


_UNITS = {"hour": "HOURS", "hours": "HOURS", "day": "DAYS", "days": "DAYS",
          "minute": "MINUTES", "minutes": "MINUTES"}


def since(asof, n: int, unit: str = "day") -> Column:
    """``DATEADD(unit, -n, asof)``: the lower bound of a rolling look-back.

    With a literal ``asof`` Catalyst folds this to a constant, so a filter
    ``ts >= since(...)`` is pushed into the Parquet scan (row-group skipping,
    partition pruning on date-partitioned data).
    """
    key = unit.lower()
    if key not in _UNITS:
        raise ValueError(f"unsupported unit {unit!r}")
    return asof_or_now(asof) - F.expr(f"INTERVAL {int(n)} {_UNITS[key]}")


def at_or_after(ts, bound: Column, date_col: str | None = None, inclusive: bool = True) -> Column:
    """``ts >= bound`` (or ``>``), plus the same bound on a date partition column.

    On a table partitioned by the date of ``ts`` (see
    ``sources.sinks.write_date_partitioned``), the added
    ``date_col >= to_date(bound)`` folds to a date literal and becomes a
    partition filter, so older partitions are never listed or read.
    """
    c = as_column(ts)
    cond = c >= bound if inclusive else c > bound
    if date_col:
        cond = cond & (F.col(date_col) >= F.to_date(bound))
    return cond


def in_lookback(ts, asof, n: int, unit: str = "day", date_col: str | None = None) -> Column:
    """Rows inside the rolling look-back ``[asof - n unit, ...)``."""
    return at_or_after(ts, since(asof, n, unit), date_col)


def _boundaries_crossed(unit: str, start, end) -> Column:
    # DATEDIFF in the warehouse dialect counts unit boundaries crossed, not
    # elapsed whole units: truncate both ends first, then take the difference.
    # date_trunc of an NTZ value yields a session-zone timestamp, so cast back.
    s = F.date_trunc(unit, as_column(start)).cast("timestamp_ntz")
    e = F.date_trunc(unit, as_column(end)).cast("timestamp_ntz")
    return F.timestamp_diff(unit.upper(), s, e)


def hours_crossed(start, end) -> Column:
    """``DATEDIFF('hour', start, end)`` with boundary-counting semantics."""
    return _boundaries_crossed("hour", start, end)


def minutes_crossed(start, end) -> Column:
    """``DATEDIFF('minute', start, end)`` with boundary-counting semantics."""
    return _boundaries_crossed("minute", start, end)


def to_number_or_null(s) -> Column:
    """``TRY_TO_NUMBER(s)``: integer value or NULL on malformed input.

    Parsed through decimal(38,0) so '101.6' rounds to 102 and '1e2' gives 100,
    the same as the tolerant warehouse parse; outer blanks are ignored.
    """
    return as_column(s).try_cast("decimal(38,0)").try_cast("bigint")


def normalize_key(s, trim: bool = True) -> Column:
    """``TRY_TO_NUMBER(TRIM(s))`` (or without TRIM)."""
    c = as_column(s)
    return to_number_or_null(F.trim(c) if trim else c)


def freshness_hours_expr(max_ts, asof) -> Column:
    """Hours between the latest load and ``asof``, one decimal, NULL if none.

    Elapsed seconds / 3600 rounded half-to-even, as the client-side rounding
    does; exact in microseconds, so independent of row order.
    """
    micros = F.unix_micros(asof_or_now(asof).cast("timestamp")) - F.unix_micros(as_column(max_ts).cast("timestamp"))
    return F.bround(micros / F.lit(3.6e9), 1)


def format_ts(ts) -> Column:
    """``%Y-%m-%d %H:%M:%S`` (fractions truncated), or the no-load text."""
    return F.coalesce(F.date_format(as_column(ts), "yyyy-MM-dd HH:mm:ss"), F.lit(NO_LOAD_TEXT))


def ms_to_seconds(ms, scale: int = 2) -> Column:
    """``ROUND(total_elapsed_time / 1000, scale)``."""
    return F.round(as_column(ms) / F.lit(1000.0), scale)
