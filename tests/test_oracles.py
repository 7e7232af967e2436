"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import duck, rows  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle_or_a_brute_force_test():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    here = os.path.join(os.path.dirname(os.path.abspath(__file__)), "llm")
    named = "".join(open(os.path.join(here, f), encoding="utf-8").read() for f in sorted(os.listdir(here)) if f.endswith(".py")) \
        if os.path.isdir(here) else ""
    assert [q for q in set(entry.queries()) - set(entry.oracle_sql()) if q not in named] == []


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 74
    assert df.columns == ["date_dt", "timeband", "user_id", "total_visits", "commuters", "first_event",
                          "last_event", "dwell_time", "rail_trips", "other_trips", "tube_trips"]
