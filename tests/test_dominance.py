"""Dominance counts by a tree of starts against comparing all pairs of a date."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from footfall.operators.dominance import dominating_macros

DAY = dt.datetime(2024, 1, 15)
SCHEMA = "date_dt date, user_id string, first_event timestamp_ntz, last_event timestamp_ntz, level int, n string, a string"


def dwells_of(rnd, n):
    rows = []
    for k in range(n):
        first = DAY + dt.timedelta(days=rnd.randrange(2), seconds=rnd.choice([0, 1, 65535, 65536, 86399, rnd.randrange(86400)]))
        last = first + dt.timedelta(seconds=rnd.choice([0, 60, 3600, rnd.randrange(40000)]))
        rows.append((first.date(), f"u{k % 5}", first, last, 3, "clash", "x"))
    return rows + rows[:3] + [(None, "u", DAY, DAY, 0, "", ""), (DAY.date(), None, None, DAY, 0, "", ""), (DAY.date(), "u", DAY, None, 0, "", "")]


def compared(micro, macro):
    out = []
    for day, user, first, last, *_ in micro:
        met = sorted({(f, e) for d, _, f, e, *_ in macro
                      if None not in (day, first, last, d, f, e) and d == day and f >= first and e >= last})
        out.append((day, user, first, last, len(met), *(met[0] if met else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_dominance(spark, seed):
    rnd = random.Random(seed)
    micro, macro = dwells_of(rnd, 150), dwells_of(rnd, 80)
    tables = [spark.createDataFrame(x, SCHEMA).repartition(3) for x in (micro, macro)]
    found = dominating_macros(*tables)
    assert sorted((tuple(r) for r in found.collect()), key=str) == compared(micro, macro)
    if seed == 1:
        assert dominating_macros(tables[0].where("false"), tables[1]).count() == 0
        alone = dominating_macros(tables[0], tables[1].where("false")).collect()
        assert len(alone) == len(micro) and {(r["n_macro"], r["nearest_first"]) for r in alone} == {(0, None)}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
