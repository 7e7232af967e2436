"""A third of all events on one user (the ``hot`` mapping of the sf0.1 events):
bucketed operators against the literal SQL oracles."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import duck, rows  # noqa: E402

from footfall.plans.catalog import Inputs, oracle  # noqa: E402

SF = "/root/testdata/sf0.1"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def hot(spark):
    return Inputs(spark, SF, "hot")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _check(df, con, name):
    rel = con.sql(oracle(name, "hot"))
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(rel.columns, rel.fetchall())


def test_hot_user_holds_a_third(hot):
    n = hot.trace.count()
    assert hot.trace.where("user_id = 0").count() * 3 >= n


def test_hot_dwells(hot, con):
    _check(hot.dwells, con, "dwells_islands")


def test_hot_origin(hot, con):
    _check(hot.origin(), con, "origin_msoa")


def test_hot_attachment(hot, con):
    from footfall.operators import attachment as A
    _check(A.attachment_final(A.band_occupancy(hot.joined, hot.fx.time_series_table(), hot.p)), con,
           "attachment_final")


def test_hot_user_window_groups_are_a_fraction_of_its_day(hot):
    from pyspark.sql import functions as F

    from footfall.operators import dwell as D
    stage = D.event_stage(hot.site_events, hot.p).where("user_id = 0")
    biggest_group = stage.groupBy("date_dt", "_bucket").count().agg(F.max("count")).first()[0]
    busiest_day = hot.site_events.where("user_id = 0").groupBy("date_dt").count().agg(F.max("count")).first()[0]
    # A group holds its 2 h bucket plus 90 min before and 45 min after: ~255/1440 of a day.
    assert biggest_group <= 0.3 * busiest_day, (biggest_group, busiest_day)
