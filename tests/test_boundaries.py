"""Boundary cases of every time rule (FIXTURES.md section 5)."""

from __future__ import annotations

import pytest
from helpers import areas, bands, cells, dwell_rows, raw_trace, rows, ts

from footfall.operators import attachment as A
from footfall.operators import dwell as D
from footfall.operators import frequency as Q
from footfall.operators import origin as O
from footfall.params import Params
from footfall.sources.trace import normalise_trace

SITE = [1, 2]


def site_events(spark, trace_rows):
    return D.events_at_site(normalise_trace(raw_trace(spark, trace_rows)), cells(spark, SITE))


def both_modes(spark, trace_rows, p=Params()):
    ev = site_events(spark, trace_rows)
    micro = D.micro_dwells(ev, p)
    contained = dwell_rows(D.dwell_islands(micro, p))
    literal = dwell_rows(D.resolve_contained(micro, D.macro_dwells(micro, p), p))
    assert contained == literal
    return contained


@pytest.mark.parametrize("gap_s, dwell", [(60, True), (2700, True), (59, False), (2701, False)])
def test_pair_gap_bounds(spark, gap_s, dwell):
    t0 = ts("2024-01-15 10:00:00")
    t1 = (t0 + __import__("datetime").timedelta(seconds=gap_s)).isoformat(sep=" ")
    got = both_modes(spark, [(7, "2024-01-15 10:00:00", 1), (7, t1, 1)])
    assert got == ([(7, t0, ts(t1))] if dwell else [])


def test_single_and_identical_events(spark):
    assert both_modes(spark, [(7, "2024-01-15 10:00:00", 1)]) == []
    assert both_modes(spark, [(7, "2024-01-15 10:00:00", 1), (7, "2024-01-15 10:00:00", 2)]) == []


def test_chain_of_40_minute_gaps_merges(spark):
    got = both_modes(spark, [(7, "2024-01-15 10:00:00", 1), (7, "2024-01-15 10:40:00", 1),
                             (7, "2024-01-15 11:20:00", 2)])
    assert got == [(7, ts("2024-01-15 10:00:00"), ts("2024-01-15 11:20:00"))]


def test_chain_across_many_buckets(spark):
    # 30-minute steps over 10 hours: one dwell, spanning ten hour buckets.
    times = [f"2024-01-15 {8 + k // 2:02d}:{30 * (k % 2):02d}:00" for k in range(21)]
    got = both_modes(spark, [(7, t, 1) for t in times])
    assert got == [(7, ts(times[0]), ts(times[-1]))]


def test_no_pairing_across_midnight(spark):
    assert both_modes(spark, [(7, "2024-01-15 23:50:00", 1), (7, "2024-01-16 00:10:00", 1)]) == []


def test_null_time_and_cell_rows_removed(spark):
    # Null cell: dropped by the site join.  Null time: kept as a site event but
    # never paired (the pairing joins on date_dt).
    rows_ = [(7, None, 1), (7, "2024-01-15 10:00:00", None), (7, "2024-01-15 10:05:00", 1)]
    ev = site_events(spark, rows_)
    assert ev.count() == 2
    assert D.micro_pairs(ev).count() == 0
    assert both_modes(spark, rows_) == []


def test_coalesce_prefers_start_columns(spark):
    tr = normalise_trace(raw_trace(spark, [
        (7, "2024-01-15 10:00:00", 1, "2024-01-15 10:01:30", 1001),
        (7, None, None, "2024-01-15 11:00:00", 2),
    ]))
    assert rows(tr, "start_dt", "cell_id") == [(ts("2024-01-15 10:00:00"), 1), (ts("2024-01-15 11:00:00"), 2)]


def test_contained_vs_as_reference(spark):
    # A: short stay 10:00-10:10; B: long stay 10:05-11:00 (macro: chain of micro dwells).
    rows_ = [(1, "2024-01-15 10:00:00", 1), (1, "2024-01-15 10:10:00", 1),
             (2, "2024-01-15 10:05:00", 1), (2, "2024-01-15 10:35:00", 1), (2, "2024-01-15 11:00:00", 1)]
    p = Params()
    ev = site_events(spark, rows_)
    micro = D.micro_dwells(ev, p)
    macro = D.macro_dwells(micro, p)
    assert dwell_rows(macro) == [(2, ts("2024-01-15 10:05:00"), ts("2024-01-15 11:00:00"))]
    contained = dwell_rows(D.dwell_islands(micro, p))
    assert (1, ts("2024-01-15 10:00:00"), ts("2024-01-15 10:10:00")) in contained
    ref = dwell_rows(D.resolve_as_reference(micro, macro, p))
    assert (1, ts("2024-01-15 10:05:00"), ts("2024-01-15 11:00:00")) in ref
    assert (1, ts("2024-01-15 10:00:00"), ts("2024-01-15 10:10:00")) not in ref


def _dwell(spark, user, first, last):
    return spark.createDataFrame(
        [(user, ts(first).date(), ts(first), ts(last))],
        "user_id bigint, date_dt date, first_event timestamp_ntz, last_event timestamp_ntz")


def _trace(spark, events):
    return normalise_trace(raw_trace(spark, events))


def test_previous_event_bounds(spark):
    dw = _dwell(spark, 7, "2024-01-15 12:00:00", "2024-01-15 12:30:00")
    tr = _trace(spark, [(7, "2024-01-15 10:00:00", 5), (7, "2024-01-15 10:00:01", 5),
                        (7, "2024-01-15 11:59:59", 5), (7, "2024-01-15 12:00:00", 5)])
    got = rows(O.previous_events(tr, dw), "start_dt")
    assert got == [(ts("2024-01-15 10:00:01"),), (ts("2024-01-15 11:59:59"),)]


def test_fifteen_minute_boundaries(spark):
    p = Params(excluded_area="M0")
    dw = _dwell(spark, 7, "2024-01-15 12:00:00", "2024-01-15 12:30:00")
    tr = _trace(spark, [(7, "2024-01-15 11:45:00", 5)])
    prev = O.previous_events(tr, dw, p)
    assert O.origin_candidates(prev, areas(spark, [(5, "M5")]), p).count() == 0
    assert A.other_trips(prev, p).count() == 0


def test_rail_sixty_minute_boundary(spark):
    dw = _dwell(spark, 7, "2024-01-15 12:00:00", "2024-01-15 12:30:00")
    rail = cells(spark, [9], "cell_id")
    exact = O.previous_events(_trace(spark, [(7, "2024-01-15 11:00:00", 9)]), dw)
    inside = O.previous_events(_trace(spark, [(7, "2024-01-15 11:00:01", 9)]), dw)
    assert A.rail_trips(exact, rail).count() == 0
    assert A.rail_trips(inside, rail).count() == 1
    flags = A.arrival_flags(inside, rail).collect()
    assert [(r["rail_trips"], r["other_mode"]) for r in flags] == [(1, None)]


def test_cell_in_two_areas_and_tie_break(spark):
    p = Params(excluded_area="M0")
    dw = _dwell(spark, 7, "2024-01-15 12:00:00", "2024-01-15 12:30:00")
    tr = _trace(spark, [(7, "2024-01-15 11:00:00", 4), (7, "2024-01-15 11:10:00", 3)])
    area = areas(spark, [(3, "M3"), (4, "M4"), (4, "M9")])
    cand = O.origin_candidates(O.previous_events(tr, dw, p), area, p)
    assert rows(cand, "cell_id", "number_events") == [(3, 1), (4, 2)]
    # Equal counts: smaller cell wins.
    area2 = areas(spark, [(3, "M3"), (4, "M4")])
    cand2 = O.origin_candidates(O.previous_events(tr, dw, p), area2, p)
    assert rows(O.origin_top_cell(cand2), "cell_id") == [(3,)]
    origin = O.visitor_origin(dw, O.origin_top_cell(cand2), area2)
    assert rows(origin, "origin_msoa") == [("M3",)]


def test_band_boundaries(spark):
    p = Params()
    # first_event exactly on a band (10:00); last_event = 10:45 band - 14 min.
    dw = _dwell(spark, 7, "2024-01-15 10:00:00", "2024-01-15 10:31:00")
    occ = A.band_occupancy(dw, bands(spark), p)
    seq = A.band_occupancy_sequence(dw, 900, 96, p)
    expect = [(ts("2024-01-15 10:15:00"),), (ts("2024-01-15 10:30:00"),)]
    assert rows(occ, "ts") == expect
    assert rows(seq, "ts") == expect


def test_band_run_date_mode_and_bad_text(spark):
    dw = _dwell(spark, 7, "2024-01-15 10:00:00", "2024-01-15 10:20:00")
    series = spark.createDataFrame([("10:15:00",), ("xx:yy",), (None,)], "ts string")
    assert rows(A.band_occupancy(dw, series, run_date="2024-01-15"), "ts") == [(ts("2024-01-15 10:15:00"),)]
    assert A.band_occupancy(dw, series, run_date="2024-01-16").count() == 0


def test_attachment_modes(spark):
    dw = spark.createDataFrame(
        [(1, ts("2024-01-15 10:00:00").date(), ts("2024-01-15 10:00:00"), ts("2024-01-15 10:20:00"))] * 1,
        "user_id bigint, date_dt date, first_event timestamp_ntz, last_event timestamp_ntz")
    users = spark.createDataFrame([(1, 7, 3, 1)], "user_id bigint, total_visits bigint, total_days bigint, "
                                                  "commuters int")
    for rail, other, expect in [(1, 1, (1, 0, 0)), (None, 1, (None, 1, 0)), (None, None, (None, 0, 1))]:
        flags = spark.createDataFrame(
            [(1, ts("2024-01-15 10:00:00").date(), ts("2024-01-15 10:00:00"), ts("2024-01-15 10:20:00"),
              rail, other)],
            "user_id bigint, date_dt date, first_event timestamp_ntz, last_event timestamp_ntz, "
            "rail_trips int, other_mode int")
        out = A.attachment_final(A.band_occupancy(A.attachment_joined(dw, users, flags), bands(spark)))
        got = rows(out, "rail_trips", "other_trips", "tube_trips", "dwell_time")
        assert got == [(*expect, 15.0), (*expect, 30.0)]   # bands 10:15 and 10:30


def test_commuter_threshold(spark):
    def dwells(n):
        return spark.createDataFrame(
            [(1, ts(f"2024-01-{d + 1:02d} 10:00:00").date()) for d in range(n)], "user_id bigint, date_dt date")
    assert Q.user_frequency(dwells(6)).collect()[0]["commuters"] == 0
    assert Q.user_frequency(dwells(7)).collect()[0]["commuters"] == 1


@pytest.mark.parametrize("run_date", [None, "2024-01-15"])
def test_band_join_irregular_bands_vs_theta_join(spark, run_date):
    import datetime as dt
    import random

    from pyspark.sql import functions as F
    rnd = random.Random(7)
    times = sorted({f"{h:02d}:{m:02d}:{s:02d}" for h, m, s in
                    [(rnd.randrange(24), rnd.randrange(60), rnd.randrange(60)) for _ in range(40)]}
                   | {"00:00:00", "23:59:59", "12:00:00"})
    series = spark.createDataFrame([(t,) for t in times], "ts string")
    rows_ = []
    for k in range(60):
        day = dt.date(2024, 1, 14 + k % 3)
        first = dt.datetime.combine(day, dt.time()) + dt.timedelta(seconds=rnd.randrange(86400))
        last = min(first + dt.timedelta(seconds=rnd.randrange(60, 6 * 3600)),
                   dt.datetime.combine(day, dt.time(23, 59, 59)))
        rows_.append((k, day, first, last))
    dw = spark.createDataFrame(rows_, "user_id bigint, date_dt date, first_event timestamp_ntz, "
                                      "last_event timestamp_ntz")
    got = A.band_occupancy(dw, series, run_date=run_date)
    day_col = F.lit(run_date) if run_date else F.col("date_dt").cast("string")
    bands = series.select(F.col("ts").alias("band"))
    brute = (dw.join(bands, how="cross")    # brute-force check only
             .withColumn("ts", F.concat(day_col, F.lit(" "), "band").try_cast("timestamp_ntz"))
             .where((F.col("ts") > F.col("first_event"))
                    & (F.col("last_event") > F.col("ts") - F.expr("INTERVAL 14 MINUTES")))
             .drop("band"))
    cols = ["user_id", "date_dt", "first_event", "last_event", "ts"]
    assert got.select(*cols).exceptAll(brute.select(*cols)).count() == 0
    assert brute.select(*cols).exceptAll(got.select(*cols)).count() == 0
    assert got.count() > 0
