"""Dwells on random traces with gaps at the rule boundaries, against the literal
SQL form of the rules run by DuckDB (pairs self-join, numbered links, islands,
containment join, date-only join)."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from footfall.operators import dwell as D
from footfall.params import Params
from footfall.plans.catalog import DWELL_CTES

# Gaps in seconds, biased to the boundaries of the pairing rule (60 s, 2700 s).
GAPS = [0, 1, 30, 59, 60, 61, 300, 900, 1799, 2640, 2699, 2700, 2701, 3000, 5400]


def _trace(seed: int) -> pd.DataFrame:
    rnd = random.Random(seed)
    rows = []
    for user in range(6):
        t = dt.datetime(2024, 1, 15) + dt.timedelta(seconds=rnd.randrange(3600))
        n = 300 if user == 0 else 40          # user 0 is the busy one
        for _ in range(n):
            t += dt.timedelta(seconds=rnd.choice(GAPS))
            rows.append((user, t.date(), t))
    return pd.DataFrame(rows, columns=["user_id", "date_dt", "start_dt"])


def _duck(trace: pd.DataFrame, relation: str) -> set[tuple]:
    con = duckdb.connect()
    con.register("trace_df", trace)
    sql = f"WITH site_events AS (SELECT * FROM trace_df), {DWELL_CTES} SELECT * FROM {relation}"
    rel = con.sql(sql)
    cols = rel.columns
    return {tuple(r[cols.index(c)] for c in ("date_dt", "user_id", "first_event", "last_event"))
            for r in rel.fetchall()}


def _spark(df) -> set[tuple]:
    return {(r["date_dt"], r["user_id"], r["first_event"], r["last_event"]) for r in df.collect()}


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_dwells_match_literal_rules(spark, seed):
    trace = _trace(seed)
    ev = spark.createDataFrame(trace, "user_id bigint, date_dt date, start_dt timestamp_ntz")
    p = Params()
    micro = _spark(D.micro_dwells(ev, p))
    assert micro == _duck(trace, "micro")
    assert _spark(D.dwells(ev, "contained", p)) == _duck(trace, "dwells")
    assert _spark(D.macro_dwells_from_events(ev, p)) == _duck(trace, "macro")
    assert _spark(D.dwells(ev, "as_reference", p)) == _duck(trace, "dwells_ref")
