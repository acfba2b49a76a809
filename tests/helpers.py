from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def col_values(df: DataFrame, c: str) -> list:
    return [r[c] for r in df.collect()]
