"""Visit frequency and the commuter flag over a trailing window of dwells."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from ..sources.trace import trailing_window


def user_day_visits(dwells: DataFrame) -> DataFrame:
    """``(date_dt, user_id, visits)``: dwells per user and day."""
    return dwells.groupBy("date_dt", "user_id").agg(F.count(F.lit(1)).alias("visits"))


def user_frequency(dwells: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``(user_id, total_visits, total_days, commuters)`` over the given dwells.

    The per-day count followed by a sum equals one count per user, so both
    aggregates run in one grouping (partial aggregation keeps a busy user cheap);
    days are distinct non-null ``date_dt``.  Commuter: more than
    ``commuter_over`` visits.
    """
    return (
        dwells.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("total_visits"), F.count_distinct("date_dt").alias("total_days"))
        .withColumn("commuters", F.when(F.col("total_visits") > F.lit(p.commuter_over), 1).otherwise(0))
    )


def visit_frequency(dwells_table: DataFrame, run_date: str | dt.date, p: Params = DEFAULT,
                    window_mode: str = "trailing") -> DataFrame:
    """Frequency over the dwells partitions of ``run_date - trailing_days .. run_date``.

    ``window_mode='componentwise'`` reproduces the original per-component text
    comparison of year, month and day (empty for most run dates).
    """
    return user_frequency(trailing_window(dwells_table, run_date, p.trailing_days, window_mode), p)
