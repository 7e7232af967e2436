"""The frequency state: any order of days, reruns, late days and gaps give the trailing window's result."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from footfall.operators import frequency_state as FS
from footfall.operators.frequency import visit_frequency
from footfall.params import Params
from footfall.plans import sinks

P = Params(trailing_days=4, commuter_over=3)
FIRST = dt.date(2024, 2, 26)  # over a leap day and the end of a month
DAYS = [FIRST + dt.timedelta(days=k) for k in range(9)]


def table(spark, rows, path):
    """Dwells ``(user, day)`` as a partitioned table."""
    df = spark.createDataFrame([(d, u, dt.datetime.combine(d, dt.time(1 + k % 20)), dt.datetime.combine(d, dt.time(21)))
                                for k, (u, d) in enumerate(rows)],
                               "date_dt date, user_id string, first_event timestamp_ntz, last_event timestamp_ntz")
    sinks.overwrite_partitions(sinks.stamp_by_date(df, "2024-03-10 00:00:00"), path, sinks.OUTPUT_COLUMNS["dwells"])
    return sinks.read_table(spark, path)


def some(seed, n=120, users=("a", "b", "c", "d", "e", None)):
    rnd = random.Random(seed)
    return [(rnd.choice(users), rnd.choice(DAYS)) for _ in range(n)]


def found(df):
    return sorted((tuple(r) for r in df.select("user_id", "total_visits", "total_days", "commuters").collect()), key=str)


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "dwells"), str(tmp_path / "state")


def test_days_in_turn(spark, paths):
    dwells = table(spark, some(1) + [("once", DAYS[1])], paths[0])
    for day in DAYS:
        got = FS.advance(dwells, paths[1], day, P)
        assert found(got) == found(visit_frequency(dwells, day, P))
    assert "once" not in {r["user_id"] for r in FS.read_version(spark, paths[1], DAYS[-1]).collect()}
    rings = [r["ring"] for r in FS.read_version(spark, paths[1], DAYS[-1]).collect()]
    assert max(map(len, rings)) <= P.trailing_days + 1
    assert all([x["day"] for x in ring] == sorted({x["day"] for x in ring}) for ring in rings)


def test_rerun_gives_the_same_version(spark, paths):
    dwells = table(spark, some(2), paths[0])
    for day in DAYS[:4]:
        FS.advance(dwells, paths[1], day, P)
    before = [sorted(map(str, FS.read_version(spark, paths[1], d).collect())) for d in DAYS[:4]]
    for day in (DAYS[3], DAYS[2], DAYS[3]):
        FS.advance(dwells, paths[1], day, P)
    assert [sorted(map(str, FS.read_version(spark, paths[1], d).collect())) for d in DAYS[:4]] == before


def test_late_day(spark, paths):
    rows = some(3)
    dwells = table(spark, [r for r in rows if r[1] != DAYS[2]], paths[0])
    for day in DAYS[:6]:
        FS.advance(dwells, paths[1], day, P)
    dwells = table(spark, rows + [("late", DAYS[2])], paths[0])  # the day arrives after the sixth run
    for as_of in DAYS[2:6]:
        FS.amend(dwells, paths[1], DAYS[2], as_of, P)
        assert found(FS.frequency_of(FS.read_version(spark, paths[1], as_of), P)) == found(visit_frequency(dwells, as_of, P))
    assert found(FS.advance(dwells, paths[1], DAYS[6], P)) == found(visit_frequency(dwells, DAYS[6], P))
    # A day before the window changes nothing.
    FS.amend(dwells, paths[1], DAYS[0], DAYS[6], P)
    assert found(FS.frequency_of(FS.read_version(spark, paths[1], DAYS[6]), P)) == found(visit_frequency(dwells, DAYS[6], P))


def test_a_corrected_day_that_lost_its_visits(spark, paths):
    rows = [("a", DAYS[0]), ("a", DAYS[1]), ("b", DAYS[1]), ("b", DAYS[1]), ("c", DAYS[2])]
    dwells = table(spark, rows, paths[0])
    for day in DAYS[:3]:
        FS.advance(dwells, paths[1], day, P)
    dwells = table(spark, [("a", DAYS[1])], paths[0])  # replaces that day's partition: b is gone
    FS.amend(dwells, paths[1], DAYS[1], DAYS[2], P)
    assert found(FS.frequency_of(FS.read_version(spark, paths[1], DAYS[2]), P)) == [("a", 2, 2, 0), ("c", 1, 1, 0)]


def test_no_visit_at_all_and_gaps(spark, paths):
    dwells = table(spark, [("a", DAYS[0])], paths[0])
    assert found(FS.advance(dwells, paths[1], DAYS[0], P)) == [("a", 1, 1, 0)]
    for day in DAYS[1:5]:
        assert found(FS.advance(dwells, paths[1], day, P)) == [("a", 1, 1, 0)]
    assert found(FS.advance(dwells, paths[1], DAYS[5], P)) == []  # the visit left; no version is kept
    assert FS.read_version(spark, paths[1], DAYS[5]) is None
    assert found(FS.advance(dwells, paths[1], DAYS[8], P)) == []  # no version of the day before: from the window
    state = FS.fold_day(FS.read_version(spark, paths[1], DAYS[2]), FS.day_visits(dwells, DAYS[7]), DAYS[7], DAYS[7], P)
    assert state.count() == 0  # five days at once


def test_a_run_reads_one_day_and_the_state(spark, paths):
    dwells = table(spark, some(4), paths[0])
    for day in DAYS[:5]:
        FS.advance(dwells, paths[1], day, P)
    state = FS.read_version(spark, paths[1], DAYS[4])
    assert all("as_of=2024-03-01" in f for f in state.inputFiles())
    plan = FS.fold_day(state, FS.day_visits(dwells, DAYS[5]), DAYS[5], DAYS[5], P)
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line]
    day_scans = [line for line in scans if "PartitionFilters: [isnotnull(year" in line or "day#" in line.split("PartitionFilters")[1]]
    assert len(scans) == 2 and len(day_scans) == 1
    assert "02" in day_scans[0].split("PartitionFilters")[1]  # 2024-03-02
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
