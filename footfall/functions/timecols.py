"""Column helpers for time arithmetic.

All bounds are expressed as timestamp +/- interval (never as formatted text),
and ordering keys are epoch microseconds, so whole-second and sub-second data
compare exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(c: Column | str) -> Column:
    """Epoch microseconds of a timestamp or timestamp_ntz column (UTC session)."""
    return F.unix_micros(col_(c).cast("timestamp"))


def seconds(n: int) -> Column:
    """A day-time interval literal of ``n`` seconds."""
    return F.expr(f"INTERVAL '{int(n)}' SECOND")


def minus_s(c: Column | str, n: int) -> Column:
    return col_(c) - seconds(n)


def plus_s(c: Column | str, n: int) -> Column:
    return col_(c) + seconds(n)


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    """(unix seconds of ``later`` - unix seconds of ``earlier``) / 60, as double."""
    secs = F.unix_seconds(col_(later).cast("timestamp")) - F.unix_seconds(col_(earlier).cast("timestamp"))
    return secs / F.lit(60)


def to_ntz(c: Column | str) -> Column:
    return col_(c).cast("timestamp_ntz")


def truncate_seconds(c: Column | str) -> Column:
    """Drop sub-second digits, keeping the wall-clock (ntz) type."""
    return F.date_trunc("second", col_(c)).cast("timestamp_ntz")


def day_parts(date_col: Column | str) -> dict[str, Column]:
    """Zero-padded ``year``, ``month``, ``day`` text of a date (partition values)."""
    d = col_(date_col)
    return {
        "year": F.date_format(d, "yyyy"),
        "month": F.date_format(d, "MM"),
        "day": F.date_format(d, "dd"),
    }


def partition_date(year: Column | str = "year", month: Column | str = "month",
                   day: Column | str = "day") -> Column:
    """Date from the three text partition columns (a malformed value gives null,
    so that partition is not selected, instead of failing the scan)."""
    return F.make_date(col_(year).try_cast("int"), col_(month).try_cast("int"), col_(day).try_cast("int"))
