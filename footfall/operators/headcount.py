"""How many visitors are inside at each time band, by a sweep over arrivals and departures.

``attachment.band_occupancy`` makes a row per dwell and band, which a count needs not.  Here a dwell
is two deltas: +1 right after its ``first_event``, -1 at its ``last_event`` plus the band slack.  Deltas of one
time are added up before anything is sorted, hours are summed, a prefix sum over the hours of a day
gives the count at the start of each hour, and a running sum inside the hour meets the bands.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_us, plus_s
from ..params import DEFAULT, Params
from ..sources.dimensions import band_hour

HOUR_US = 3600 * 1_000_000
# Order at one time: departures count at their time, bands are asked, arrivals count after it.
DEPARTURE, BAND, ARRIVAL = 0, 1, 2


def _midnight(run_date: str | dt.date | None) -> Column:
    day = F.lit(str(run_date)).cast("date") if run_date is not None else F.col("date_dt")
    return day.cast("timestamp_ntz")


def occupancy_deltas(dwells: DataFrame, p: Params = DEFAULT, run_date: str | dt.date | None = None,
                     by: Sequence[str] = ()) -> DataFrame:
    """``date_dt, *by, hour, us, kind, delta``: arrivals and departures per time of the bands' day.

    ``us`` is counted from midnight of the bands' day; what happens before that counts from its
    start on, what happens after its end is left out.  Added up per time, so with whole-second
    events an hour of a day has at most 7200 rows, however many dwells there are.
    """
    zero = epoch_us(_midnight(run_date))

    def side(at: Column, kind: int, delta: int) -> DataFrame:
        us = F.greatest(epoch_us(at) - zero, F.lit(-1).cast("long"))
        return dwells.select("date_dt", *by, us.alias("us"), F.lit(kind).alias("kind"), F.lit(delta).alias("delta"))

    both = side(F.col("first_event"), ARRIVAL, 1).unionByName(side(plus_s("last_event", p.band_slack_s), DEPARTURE, -1))
    hour = F.floor(F.greatest(F.col("us"), F.lit(0)) / HOUR_US).cast("int")
    return (both.where(F.col("us") < 24 * HOUR_US).withColumn("hour", hour)
            .groupBy("date_dt", *by, "hour", "us", "kind").agg(F.sum("delta").alias("delta")))


def hour_starts(deltas: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``date_dt, *by, hour, present``: who is inside when each of the 24 hours starts."""
    counts = [F.coalesce(F.sum(F.when(F.col("hour") < h, F.col("delta"))), F.lit(0)).cast("long").alias(str(h))
              for h in range(24)]
    keys = ["date_dt", *by]
    return (deltas.groupBy(*keys).agg(*counts).unpivot(keys, [str(h) for h in range(24)], "hour", "present")
            .withColumn("hour", F.col("hour").cast("int")))


def band_headcount(dwells: DataFrame, series: DataFrame, p: Params = DEFAULT,
                   run_date: str | dt.date | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``date_dt, *by, ts, headcount``: dwells with ``ts > first_event`` and ``last_event > ts - band_slack`` per
    band, for bands with at least one (the rows per band of ``band_occupancy``, counted).

    Bands are the distinct text times of ``series`` on ``run_date`` or, without it, on each dwell's own
    date; malformed ones are left out.  ``by`` splits the count by columns of the dwells (nulls are a
    value).
    """
    keys = ["date_dt", *by]
    deltas = occupancy_deltas(dwells, p, run_date, by)
    bands = (series.select(band_hour("ts").alias("hour"),
                           epoch_us(F.concat(F.lit("1970-01-01 "), F.col("ts")).try_cast("timestamp_ntz")).alias("us"))
             .where("us is not null").distinct())
    asked = hour_starts(deltas, by).join(bands, "hour").select(
        *keys, "hour", "us", F.lit(BAND).alias("kind"), F.col("present").alias("delta"))
    swept = Window.partitionBy(*keys, "hour").orderBy("us", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A band brings the count at the start of its hour, to which only deltas are added.
    since = F.sum(F.when(F.col("kind") != BAND, F.col("delta")).otherwise(0)).over(swept)
    ts = F.timestamp_micros(epoch_us(_midnight(run_date)) + F.col("us")).cast("timestamp_ntz")
    return (asked.unionByName(deltas).withColumn("headcount", (F.col("delta") + since).cast("long"))
            .where((F.col("kind") == BAND) & (F.col("headcount") > 0))
            .select(*keys, ts.alias("ts"), "headcount"))
