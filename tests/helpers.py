"""Small hand-made inputs for boundary tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRACE_SCHEMA = ("imsi bigint, start_timestamp timestamp_ntz, end_timestamp timestamp_ntz, "
                "start_source_cell_id int, end_source_cell_id int, year string, month string, day string")


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def raw_trace(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows: (imsi, start 'YYYY-MM-DD HH:MM:SS' or None, cell or None[, end, end_cell])."""
    out = []
    for r in rows:
        imsi, start, cell = r[0], r[1], r[2]
        end = r[3] if len(r) > 3 else None
        end_cell = r[4] if len(r) > 4 else None
        when = ts(start) if start else (ts(end) if end else None)
        parts = (f"{when.year:04d}", f"{when.month:02d}", f"{when.day:02d}") if when else ("2024", "01", "15")
        out.append((imsi, ts(start) if start else None, ts(end) if end else None, cell, end_cell, *parts))
    return spark.createDataFrame(out, TRACE_SCHEMA)


def cells(spark: SparkSession, ids: list[int], name: str = "source_cell_id") -> DataFrame:
    return spark.createDataFrame([(i,) for i in ids], f"{name} int")


def areas(spark: SparkSession, pairs: list[tuple[int, str]]) -> DataFrame:
    return spark.createDataFrame(pairs, "source_cell_id int, msoa string")


def bands(spark: SparkSession, step_min: int = 15) -> DataFrame:
    return spark.createDataFrame(
        [(f"{m // 60:02d}:{m % 60:02d}:00",) for m in range(0, 24 * 60, step_min)], "ts string")


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def dwell_rows(df: DataFrame) -> list[tuple]:
    return rows(df, "user_id", "first_event", "last_event")


def lit_date(d: str):
    return F.lit(d).cast("date")
