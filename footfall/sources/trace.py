"""Trace scans: day partitions, normalisation, trailing windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import partition_date

TRACE_COLUMNS = ["user_id", "date_dt", "start_dt", "cell_id", "year", "month", "day"]


def run_date_parts(run_date: str | dt.date) -> tuple[str, str, str]:
    """``'2024-01-15'`` -> ``('2024', '01', '15')`` (zero-padded partition text)."""
    d = run_date if isinstance(run_date, dt.date) else dt.date.fromisoformat(run_date)
    return f"{d.year:04d}", f"{d.month:02d}", f"{d.day:02d}"


def day_predicate(run_date: str | dt.date) -> Column:
    """Equality on the three string partition columns (pruned by Catalyst)."""
    y, m, d = run_date_parts(run_date)
    return (F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d)


def scan_day(table: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Keep one day partition of a ``year/month/day`` partitioned table."""
    return table.where(day_predicate(run_date))


def normalise_trace(raw: DataFrame) -> DataFrame:
    """Raw trace -> ``user_id, date_dt, start_dt, cell_id, year, month, day``.

    The event time is the start time, else the end time; the cell is the start
    cell, else the end cell.  Rows whose time or cell stays null are dropped later
    by the inner joins that use them as keys.
    """
    # Whole seconds, as the original compares them.
    start = F.date_trunc("SECOND", F.coalesce("start_timestamp", "end_timestamp")).cast("timestamp_ntz")
    return raw.select(
        F.col("imsi").alias("user_id"),
        F.to_date(start).alias("date_dt"),
        start.alias("start_dt"),
        F.coalesce("start_source_cell_id", "end_source_cell_id").alias("cell_id"),
        "year", "month", "day",
    )


def trailing_predicate(run_date: str | dt.date, days: int) -> Column:
    """Partitions whose date lies in ``[run_date - days, run_date]``.

    Besides the exact date test it repeats the bound on ``year`` alone (and on
    ``month`` when the window stays in one year) so that plain partition
    pruning applies even where the date expression is not pushed.
    """
    end = run_date if isinstance(run_date, dt.date) else dt.date.fromisoformat(run_date)
    start = end - dt.timedelta(days=days)
    pred = partition_date().between(F.lit(start), F.lit(end))
    pred = pred & F.col("year").between(f"{start.year:04d}", f"{end.year:04d}")
    if start.year == end.year:
        pred = pred & F.col("month").between(f"{start.month:02d}", f"{end.month:02d}")
    return pred


def componentwise_predicate(run_date: str | dt.date, days: int) -> Column:
    """The original window test: year, month and day compared separately as text.

    Selects the true window only when it stays inside one month; e.g. for
    2019-11-15 it asks for ``day >= '16' and day <= '15'`` and selects nothing.
    Kept to reproduce historical outputs.
    """
    end = run_date if isinstance(run_date, dt.date) else dt.date.fromisoformat(run_date)
    start = end - dt.timedelta(days=days)
    sy, sm, sd = run_date_parts(start)
    ey, em, ed = run_date_parts(end)
    return (F.col("year").between(sy, ey) & F.col("month").between(sm, em)
            & F.col("day").between(sd, ed))


def trailing_window(table: DataFrame, run_date: str | dt.date, days: int,
                    mode: str = "trailing") -> DataFrame:
    """Rows of the partitions in the look-back window of ``run_date``."""
    if mode == "trailing":
        return table.where(trailing_predicate(run_date, days))
    if mode == "componentwise":
        return table.where(componentwise_predicate(run_date, days))
    raise ValueError(f"unknown window mode {mode!r}")
