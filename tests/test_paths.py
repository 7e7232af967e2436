"""Code paths the fixture queries do not take: fallbacks, options, helpers, errors."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from footfall.operators import dwell as D
from footfall.operators import origin as O
from footfall.plans.catalog import Inputs
from footfall.sources import dimensions as dims
from footfall.sources.trace import trailing_window

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cluster_without_checkpoint_dir_is_refused(monkeypatch):
    from footfall import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_repeated_bands_give_repeated_rows(spark):
    from footfall.operators.attachment import band_occupancy
    from helpers import bands, ts

    dwells = spark.createDataFrame([(ts("2024-01-15 10:00:00").date(), 1, ts("2024-01-15 10:00:00"),
                                     ts("2024-01-15 10:05:00"))],
                                   "date_dt date, user_id long, first_event timestamp_ntz, last_event timestamp_ntz")
    series = bands(spark)
    once = band_occupancy(dwells, series).count()
    assert once > 0 and band_occupancy(dwells, series.union(series)).count() == 2 * once


def test_event_times_are_whole_seconds(spark):
    from footfall.sources.trace import normalise_trace
    from helpers import raw_trace

    found = normalise_trace(raw_trace(spark, [(1, "2024-01-15 10:00:00.900", 5)])).first()
    assert found["start_dt"].microsecond == 0 and found["start_dt"].second == 0


@needs_data
def test_previous_events_with_and_without_prefilter(spark):
    i = Inputs(spark, SF)
    with_pf = O.previous_events(i.trace, i.dwells_written, i.p, prefilter=True)
    without = O.previous_events(i.trace, i.dwells_written, i.p, prefilter=False)
    _same(with_pf, without)
    assert with_pf.count() == 1789


@needs_data
def test_origin_helper_matches_catalog(spark):
    i = Inputs(spark, SF)
    _same(O.origin(i.trace, i.dwells_written, i.fx.area_cell_table(), i.p), i.origin())


def test_band_timestamps_on_run_date(spark):
    series = spark.createDataFrame([("00:15:00",), ("bad",)], "ts string")
    got = [r["ts"] for r in dims.band_timestamps(series, "2024-01-15").collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == [dt.datetime(2024, 1, 15, 0, 15), None]


def test_unknown_modes_raise(spark):
    df = spark.createDataFrame([], "user_id bigint, date_dt date, first_event timestamp_ntz, "
                                   "last_event timestamp_ntz, year string, month string, day string")
    with pytest.raises(ValueError):
        D.resolve_dwells(df, df, mode="nope")
    with pytest.raises(ValueError):
        trailing_window(df, "2024-01-31", 30, mode="nope")


@needs_data
def test_dwell_modes_through_one_entry_point(spark):
    i = Inputs(spark, SF)
    assert D.dwells(i.site_events, "contained", i.p).count() == 1298
    assert D.dwells(i.site_events, "as_reference", i.p).where(F.col("user_id").isNotNull()).count() == 2882


def test_params_reject_rail_window_beyond_lookback():
    from footfall.params import Params
    with pytest.raises(ValueError):
        Params(rail_recent_s=3 * 3600)
    with pytest.raises(ValueError):
        Params(bucket_s=60)
