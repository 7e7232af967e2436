"""The as-of match against looking through all events of the user."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from footfall.operators.asof import last_event_before
from footfall.params import Params

DAY = dt.datetime(2024, 1, 1)
TRACE = "user_id bigint, date_dt date, start_dt timestamp_ntz, cell_id int, bucket int, us string"
DWELLS = "date_dt date, user_id bigint, first_event timestamp_ntz, last_event timestamp_ntz, event int, kind int"


def tables(seed, users=(1, 2, 3, None), days=20):
    rnd = random.Random(seed)

    def moment():
        return DAY + dt.timedelta(days=rnd.randrange(days), seconds=rnd.choice([0, 7200, 7199, rnd.randrange(86400)]),
                                  microseconds=rnd.choice([0, 0, 1, 999999]))

    events = [(rnd.choice(users), m.date(), m, rnd.choice([5, 6, 7, None]), 1, "clash") for m in (moment() for _ in range(60))]
    events += events[:5] + [(e[0], e[1], e[2], 9, 1, "clash") for e in events[:5]] + [(1, None, None, 3, 1, "clash")]
    dwells = [(m.date(), rnd.choice([*users, 77]), m, m + dt.timedelta(minutes=5), 1, 1) for m in (moment() for _ in range(60))]
    dwells += [(e[1], e[0], e[2], e[2] + dt.timedelta(minutes=2), 1, 1) for e in events[:9]] + dwells[:2]
    return events, dwells


def plain(events, dwells):
    out = []
    for date, user, first, last, *_ in dwells:
        seen = [(e[2], e[3] is not None, e[3] or 0, e[3]) for e in events
                if user is not None and e[0] == user and e[2] is not None and e[2] < first]
        at, _, _, cell = max(seen) if seen else (None, None, None, None)
        out.append((date, user, first, last, at, cell))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket_s", [7200, 900, 86400 * 7])
def test_last_event_before(spark, bucket_s):
    events, dwells = tables(bucket_s)
    got = last_event_before(spark.createDataFrame(events, TRACE).repartition(3), spark.createDataFrame(dwells, DWELLS),
                            Params(lookback_bucket_s=bucket_s))
    assert sorted(map(tuple, got.collect()), key=str) == plain(events, dwells)


def test_empty_sides(spark):
    events, dwells = tables(1)
    trace, probes = spark.createDataFrame(events, TRACE), spark.createDataFrame(dwells, DWELLS)
    assert last_event_before(trace, probes.where("false")).count() == 0
    assert {r["last_known_event"] for r in last_event_before(trace.where("false"), probes).collect()} == {None}


def test_a_busy_user_is_many_groups(spark):
    """All rows on one user: no group holds more than the rows of its bucket, and nothing is paired."""
    events, dwells = tables(4, users=(1,), days=200)
    got = last_event_before(spark.createDataFrame(events, TRACE), spark.createDataFrame(dwells, DWELLS))
    assert sorted(map(tuple, got.collect()), key=str) == plain(events, dwells)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Generate" not in plan
    assert any("user_id" in line and "bucket" in line and "unboundedpreceding$(), currentrow$()" in line
               for line in plan.splitlines() if " Window " in line)
