"""Arrival mode (rail / other / tube) and per-time-band attachment of visitors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_us, minus_s, minutes_between, plus_s
from ..params import DEFAULT, Params
from ..sources.dimensions import rail_cells

US = 1_000_000
DWELL_KEYS = ["date_dt", "user_id", "first_event", "last_event"]
ATTACHMENT_COLUMNS = ["date_dt", "timeband", "user_id", "total_visits", "commuters", "first_event",
                      "last_event", "dwell_time", "rail_trips", "other_trips", "tube_trips"]


# ---------------------------------------------------------------- arrival mode
def rail_events(previous: DataFrame, rail_cell_table: DataFrame) -> DataFrame:
    """Previous events on rail-station cells: ``(cell_id, date_dt, start_dt, user_id)``."""
    rail = rail_cells(rail_cell_table)
    return previous.join(rail, "cell_id", "left_semi").select("cell_id", "date_dt", "start_dt", "user_id")


def rail_trips(previous: DataFrame, rail_cell_table: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Dwells with a rail-cell event in ``(first_event - rail_recent, first_event)``.

    Every such pair already is a previous event (the rail window lies inside
    the look-back), so no second join with the dwells is needed.
    """
    rail = rail_cells(rail_cell_table)
    return (
        previous.join(rail, "cell_id", "left_semi")
        .where(F.col("start_dt") > minus_s("first_event", p.rail_recent_s))
        .select(*DWELL_KEYS).distinct()
        .withColumn("rail_trips", F.lit(1))
    )


def other_trips(previous: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Dwells with any event in ``(first_event - other_recent, first_event)``."""
    return (
        previous.where(F.col("start_dt") > minus_s("first_event", p.other_recent_s))
        .select(*DWELL_KEYS).distinct()
        .withColumn("other_mode", F.lit(1))
    )


def arrival_flags(previous: DataFrame, rail_cell_table: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``rail_trips`` and ``other_mode`` flags (1 or null) per dwell in one aggregation.

    Same rows as ``rail_trips`` full-outer ``other_trips``, with one shuffle
    instead of two distincts and two joins.
    """
    rail = rail_cells(rail_cell_table).withColumn("_rail", F.lit(True))
    recent_rail = F.col("_rail").isNotNull() & (F.col("start_dt") > minus_s("first_event", p.rail_recent_s))
    recent_any = F.col("start_dt") > minus_s("first_event", p.other_recent_s)
    return (
        previous.join(rail, "cell_id", "left")
        .where(recent_rail | recent_any)
        .groupBy(*DWELL_KEYS)
        .agg(F.max(F.when(recent_rail, 1)).alias("rail_trips"),
             F.max(F.when(recent_any, 1)).alias("other_mode"))
    )


def attachment_joined(dwells: DataFrame, users: DataFrame, flags: DataFrame) -> DataFrame:
    """Dwells with the user's frequency (of the run date, whatever the dwell date)
    and the arrival flags: ``date_dt, user_id, first_event, last_event, commuters,
    total_visits, rail_trips, other_mode``."""
    u = users.select("user_id", "commuters", "total_visits")
    f = flags.select(*DWELL_KEYS, "rail_trips", "other_mode")
    return (
        dwells.select(*DWELL_KEYS)
        .join(u, "user_id", "left")
        .join(f, DWELL_KEYS, "left")
        .select(*DWELL_KEYS, "commuters", "total_visits", "rail_trips", "other_mode")
    )


# ---------------------------------------------------------------- time bands
def _base_ts(run_date: str | dt.date | None) -> Column:
    """Midnight the bands hang from: the run date, else each dwell's ``date_dt``."""
    day = F.lit(str(run_date)).cast("date") if run_date is not None else F.col("date_dt")
    return day.cast("timestamp_ntz")


def band_occupancy(dwells: DataFrame, series: DataFrame, p: Params = DEFAULT,
                   run_date: str | dt.date | None = None) -> DataFrame:
    """Dwell rows times every band ``ts`` with ``ts > first_event`` and
    ``last_event > ts - band_slack``; adds column ``ts``.

    Bands are the text times of ``series`` on ``run_date`` (the original
    behaviour) or, when ``run_date`` is None, on each dwell's own date.  The
    theta join is keyed by hour of day: a dwell is spread over the hours its
    open range ``(first_event, last_event + slack)`` covers and meets only the
    bands of those hours.  A band given twice gives two rows, as in the original.
    """
    base = _base_ts(run_date)
    day = F.date_format(base, "yyyy-MM-dd")
    bands = (
        series.select(F.col("ts").alias("band_text"))
        .withColumn("_hour", F.hour(F.concat(F.lit("1970-01-01 "), "band_text").try_cast("timestamp_ntz")))
        .where(F.col("_hour").isNotNull())
    )
    hour_us = 3600 * US
    lo = F.greatest(F.lit(0), F.floor((epoch_us("first_event") - epoch_us(base)) / F.lit(hour_us)))
    hi = F.least(F.lit(23), F.floor((epoch_us(plus_s("last_event", p.band_slack_s)) - epoch_us(base))
                                    / F.lit(hour_us)))
    spread = dwells.withColumn(
        "_hour", F.explode(F.when(lo <= hi, F.sequence(lo.cast("int"), hi.cast("int")))
                           .otherwise(F.array().cast("array<int>"))))
    ts = F.concat(day, F.lit(" "), F.col("band_text")).try_cast("timestamp_ntz")
    return (
        spread.join(bands, "_hour")
        .withColumn("ts", ts)
        .where((F.col("ts") > F.col("first_event"))
               & (F.col("last_event") > minus_s("ts", p.band_slack_s)))
        .drop("_hour", "band_text")
    )


def band_occupancy_sequence(dwells: DataFrame, step_s: int, bands_per_day: int,
                            p: Params = DEFAULT, run_date: str | dt.date | None = None) -> DataFrame:
    """``band_occupancy`` for a regular grid (``bands_per_day`` bands every
    ``step_s`` seconds from midnight), generated per dwell with ``sequence``:
    no band table, no join.
    """
    base = _base_ts(run_date)
    step = step_s * US
    rel_first = epoch_us("first_event") - epoch_us(base)
    rel_end = epoch_us(plus_s("last_event", p.band_slack_s)) - epoch_us(base)
    lo = F.greatest(F.lit(0), F.floor(rel_first / F.lit(step)) + 1)            # ts > first_event
    hi = F.least(F.lit(bands_per_day - 1), F.ceil(rel_end / F.lit(step)) - 1)  # ts < last + slack
    idx = F.explode(F.when(lo <= hi, F.sequence(lo.cast("long"), hi.cast("long")))
                    .otherwise(F.array().cast("array<long>")))
    return (
        dwells.withColumn("_i", idx)
        .withColumn("ts", F.timestamp_micros(epoch_us(base) + F.col("_i") * F.lit(step)).cast("timestamp_ntz"))
        .drop("_i")
    )


def dwell_minutes(occupancy: DataFrame) -> DataFrame:
    """Adds ``dwell_time``: minutes from ``first_event`` to the band (not capped)."""
    return occupancy.withColumn("dwell_time", minutes_between("ts", "first_event"))


def attachment_final(occupancy: DataFrame, zero_fill_rail: bool = False) -> DataFrame:
    """Final attachment rows.

    ``rail_trips`` is 1 or null as in the original output (``zero_fill_rail``
    gives 0/1); ``other_trips`` is 1 only without rail; ``tube_trips`` is 1
    when neither flag is set.
    """
    rail = F.coalesce(F.col("rail_trips"), F.lit(0)) if zero_fill_rail else F.col("rail_trips")
    return dwell_minutes(occupancy).select(
        "date_dt", F.col("ts").alias("timeband"), "user_id", "total_visits", "commuters",
        "first_event", "last_event", "dwell_time",
        rail.alias("rail_trips"),
        F.when(F.col("rail_trips") == 1, 0).when(F.col("other_mode").isNull(), 0).otherwise(1)
        .alias("other_trips"),
        F.when(F.col("rail_trips").isNull() & F.col("other_mode").isNull(), 1).otherwise(0)
        .alias("tube_trips"),
    )


def user_attachment(dwells: DataFrame, users: DataFrame, previous: DataFrame, rail_cell_table: DataFrame,
                    series: DataFrame, p: Params = DEFAULT, run_date: str | dt.date | None = None,
                    zero_fill_rail: bool = False) -> DataFrame:
    """Dwells -> one row per occupied time band with frequency and arrival mode."""
    joined = attachment_joined(dwells, users, arrival_flags(previous, rail_cell_table, p))
    return attachment_final(band_occupancy(joined, series, p, run_date), zero_fill_rail)
