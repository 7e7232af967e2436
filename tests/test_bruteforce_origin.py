"""Origin and attachment on random traces with adversarial tables (cells in two
areas, tied cell counts, rail cells, gaps on the 15 min / 60 min / 2 h bounds),
against the literal SQL chain of the oracles run by DuckDB."""

from __future__ import annotations

import datetime as dt
import os
import random
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import rows  # noqa: E402

from footfall.operators import attachment as A  # noqa: E402
from footfall.operators import dwell as D  # noqa: E402
from footfall.operators import frequency as Q  # noqa: E402
from footfall.operators import origin as O  # noqa: E402
from footfall.params import Params  # noqa: E402
from footfall.plans import sinks  # noqa: E402
from footfall.plans.catalog import _FINAL, _chain  # noqa: E402
from footfall.sources.fixtures import LOAD_TS, RUN_DATE  # noqa: E402

GAPS = [30, 59, 60, 300, 899, 900, 901, 1800, 2700, 3599, 3600, 3601, 7199, 7200, 7201, 9000]
SITE = [0, 1, 2, 3, 4, 5]
AREAS = [(c, f"M{c % 5}") for c in range(10)] + [(7, "M0"), (8, "M3"), (6, "M6")]  # cells in two areas
RAIL = [6, 9]


def _tables(seed: int):
    rnd = random.Random(seed)
    rows_ = []
    for user in range(6):
        t = dt.datetime(2024, 1, 14) + dt.timedelta(seconds=rnd.randrange(7200))
        for _ in range(160):
            t += dt.timedelta(seconds=rnd.choice(GAPS))
            cell = rnd.choice(SITE) if rnd.random() < 0.6 else rnd.randrange(6, 10)
            rows_.append((user, t.date(), t, cell, f"{t.year:04d}", f"{t.month:02d}", f"{t.day:02d}"))
    trace = pd.DataFrame(rows_, columns=["user_id", "date_dt", "start_dt", "cell_id", "year", "month", "day"])
    bands = pd.DataFrame({"ts": [f"{m // 60:02d}:{m % 60:02d}:00" for m in range(0, 1440, 15)]})
    return {
        "trace": trace,
        "site_cell_table": pd.DataFrame({"source_cell_id": SITE}),
        "area_cell_table": pd.DataFrame(AREAS, columns=["source_cell_id", "msoa"]),
        "rail_cell_table": pd.DataFrame({"cell_id": RAIL}),
        "time_series_table": bands,
    }


def _duck(tables: dict, name: str):
    con = duckdb.connect()
    for k, v in tables.items():
        con.register(f"{k}_df", v)
    chain = _chain("dense")
    rest = chain[chain.index("site AS ("):]
    heads = ",\n".join(f"{k} AS (SELECT * FROM {k}_df)" for k in tables)
    rel = con.sql(f"WITH {heads},\n{rest}\n{_FINAL[name][1]}")
    return rel.columns, rel.fetchall()


def _spark(spark, tables: dict):
    schemas = {
        "trace": "user_id bigint, date_dt date, start_dt timestamp_ntz, cell_id int, year string, month string, "
                 "day string",
        "site_cell_table": "source_cell_id int", "area_cell_table": "source_cell_id int, msoa string",
        "rail_cell_table": "cell_id int", "time_series_table": "ts string",
    }
    return {k: spark.createDataFrame(v, schemas[k]) for k, v in tables.items()}


@pytest.mark.parametrize("seed", [21, 22])
def test_origin_and_attachment_match_literal_sql(spark, seed):
    tables = _tables(seed)
    t = _spark(spark, tables)
    p = Params(excluded_area="M0")
    dwells = D.dwells_from_events(D.events_at_site(t["trace"], t["site_cell_table"]), p)
    previous = O.previous_events(t["trace"], dwells, p)
    top = O.origin_top_cell(O.origin_candidates(previous, t["area_cell_table"], p))
    origin = O.visitor_origin(dwells, top, t["area_cell_table"])
    users = Q.visit_frequency(sinks.stamp_by_date(dwells, LOAD_TS), RUN_DATE, p)
    joined = A.attachment_joined(dwells, users, A.arrival_flags(previous, t["rail_cell_table"], p))
    final = A.attachment_final(A.band_occupancy(joined, t["time_series_table"], p))
    for name, df in [("origin_candidates", O.origin_candidates(previous, t["area_cell_table"], p)),
                     ("origin_top_cell", top), ("origin_msoa", origin), ("attachment_final", final)]:
        cols, data = _duck(tables, name)
        got = rows(df.columns, [tuple(r) for r in df.collect()])
        assert sorted(df.columns) == sorted(cols), name
        assert got == rows(cols, data), name
        assert len(got) > 0, name
