"""Head counts by sweep against counting the dwells of every band."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from footfall.operators.attachment import band_occupancy
from footfall.operators.headcount import band_headcount, occupancy_deltas
from footfall.params import Params

P = Params()
DAY = dt.datetime(2024, 1, 15)
SCHEMA = "date_dt date, user_id string, first_event timestamp_ntz, last_event timestamp_ntz, commuters int, hour int, us string"


def dwells_of(spark, seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        day = DAY + dt.timedelta(days=rnd.randrange(3))
        first = day + dt.timedelta(seconds=rnd.choice([0, 900, 1800, 86399, rnd.randrange(86400)]),
                                   microseconds=rnd.choice([0, 0, 1, 999999]))
        last = first + dt.timedelta(seconds=rnd.choice([0, 60, 840, 3600, rnd.randrange(40000)]))
        rows.append((day.date(), f"u{k % 7}", first, last, rnd.choice([0, 1, None]), 5, "clash"))
    return rows


BANDS = ([f"{h:02d}:{m:02d}:00" for h in range(24) for m in (0, 15, 30, 45)] + ["00:00:00", "08:15:30", "8:7:5", "nonsense", None])


def counted(rows, bands, run_date=None, by=False):
    out = Counter()
    texts = {b for b in bands if b and b != "nonsense"}
    times = {tuple(map(int, b.split(":"))) for b in texts}
    for day, _, first, last, commuter, *_ in rows:
        base = dt.datetime.combine(run_date or day, dt.time())
        for h, m, s in times:
            ts = base + dt.timedelta(hours=h, minutes=m, seconds=s)
            if ts > first and last > ts - dt.timedelta(seconds=P.band_slack_s):
                out[(day, commuter, ts) if by else (day, ts)] += 1
    return dict(out)


@pytest.mark.parametrize("by", [False, True])
@pytest.mark.parametrize("run_date", [None, dt.date(2024, 1, 16)])
def test_headcount(spark, by, run_date):
    rows = dwells_of(spark, 3 + by)
    dwells = spark.createDataFrame(rows, SCHEMA).repartition(4)
    series = spark.createDataFrame([(b,) for b in BANDS], "ts string")
    got = band_headcount(dwells, series, P, run_date, ["commuters"] if by else [])
    found = {tuple(r[:-1]): r[-1] for r in got.collect()}
    assert found == counted(rows, BANDS, run_date, by)
    assert got.columns == ["date_dt", *(["commuters"] if by else []), "ts", "headcount"]


def test_equals_the_rows_of_band_occupancy(spark):
    dwells = spark.createDataFrame(dwells_of(spark, 9), SCHEMA)
    series = spark.createDataFrame([(b,) for b in BANDS[:96]], "ts string")
    plain = band_occupancy(dwells.drop("hour", "us"), series, P).groupBy("date_dt", "ts").agg(
        F.count(F.lit(1)).alias("headcount"))
    got = band_headcount(dwells, series, P)
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_no_dwell_or_no_band(spark):
    dwells = spark.createDataFrame(dwells_of(spark, 1, 5), SCHEMA)
    series = spark.createDataFrame([(b,) for b in BANDS], "ts string")
    assert band_headcount(dwells.where("false"), series, P).count() == 0
    assert band_headcount(dwells, series.where("false"), P).count() == 0


def test_rows_do_not_grow_with_the_dwells(spark):
    """A crowd that comes and goes in the same minutes is a few deltas; nothing is exploded per dwell."""
    first = DAY + dt.timedelta(hours=9)
    crowd = spark.range(20000).select(
        F.lit(DAY.date()).alias("date_dt"), (F.lit(first) + F.make_dt_interval(secs=(F.col("id") % 60).cast("decimal(18,6)")))
        .cast("timestamp_ntz").alias("first_event"), F.lit(first + dt.timedelta(hours=3)).cast("timestamp_ntz").alias("last_event"))
    assert occupancy_deltas(crowd, P).count() == 61
    series = spark.createDataFrame([("10:00:00",), ("09:00:00",), ("12:13:59",), ("12:14:00",)], "ts string")
    counts = band_headcount(crowd, series, P)
    assert {r["ts"].time(): r["headcount"] for r in counts.collect()} == {dt.time(10): 20000, dt.time(12, 13, 59): 20000}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
