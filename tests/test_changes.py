"""Hash trees of two versions against comparing all rows; recomputed dwells against all dwells."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from footfall.operators import dwell
from footfall.operators.changes import changed_user_days, refreshed_dwells, write_tree

SCHEMA = "date_dt date, user_id bigint, start_dt timestamp_ntz, cell_id int, n int, place string"


def version(seed, n=600):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randrange(6), seconds=60 * rnd.randrange(1440))
        rows.append((rnd.choice([at.date()] * 9 + [None]), rnd.choice([*range(12), None]), at, rnd.choice([1, 2, 3, None]),
                     rnd.choice([None, 1]), rnd.choice([None, "clash"])))
    return rows


def edited(rows, seed):
    """Some rows gone, moved, doubled, with nulls in other columns; one user new, one day untouched."""
    rnd = random.Random(seed)
    out = []
    for r in rows:
        kind = rnd.choice(["same"] * 30 + ["gone", "moved", "twice", "swapped"]) if r[0] != dt.date(2024, 1, 2) else "same"
        out += {"same": [r], "gone": [], "moved": [(*r[:3], 9, *r[4:])], "twice": [r, r],
                "swapped": [(*r[:3], r[4], r[3], r[5])]}[kind]
    rnd.shuffle(out)
    return out + [(dt.date(2024, 1, 3), 99, dt.datetime(2024, 1, 3, 5), 1, 1, "x")]


def plain(old, new):
    sides = []
    for rows in (old, new):
        days = defaultdict(Counter)
        for r in rows:
            days[r[0], r[1]][r] += 1
        sides.append(days)
    return sorted(((*k, sum(sides[0][k].values()), sum(sides[1][k].values()))
                   for k in set(sides[0]) | set(sides[1]) if sides[0][k] != sides[1][k]), key=str)


def compared(spark, folder, old, new):
    for name, rows in (("old", old), ("new", new)):
        write_tree(spark.createDataFrame(rows, SCHEMA).repartition(3), f"{folder}/{name}")
    return changed_user_days(spark, f"{folder}/old", f"{folder}/new")


@pytest.mark.parametrize("seed", [1, 2])
def test_changed_user_days(spark, tmp_path, seed):
    old = version(seed)
    new = edited(old, seed)
    got = sorted(map(tuple, compared(spark, tmp_path, old, new).collect()), key=str)
    assert got == plain(old, new) and 0 < len(got) and dt.date(2024, 1, 2) not in {g[0] for g in got}


def test_equal_versions_and_empty_ones(spark, tmp_path):
    old = version(3)
    assert compared(spark, tmp_path / "a", old, old[::-1]).count() == 0
    gone = sorted(map(tuple, compared(spark, tmp_path / "b", old, []).collect()), key=str)
    assert gone == plain(old, []) and all(g[3] == 0 for g in gone)
    assert compared(spark, tmp_path / "c", [], []).count() == 0


def test_rows_that_trade_a_null_differ(spark, tmp_path):
    """A null moved to the next column, and a row that is there once more: equal sums of plain hashes would hide them."""
    day, at = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 5)
    old = [(day, 1, at, 1, None, None), (day, 2, at, 1, 1, None), (day, 3, at, 1, 1, None)]
    new = [(day, 1, at, None, 1, None), (day, 2, at, 1, 1, None), (day, 2, at, 1, 1, None), (day, 3, at, 1, 1, None)]
    got = compared(spark, tmp_path, old, new).collect()
    assert sorted(map(tuple, got)) == [(day, 1, 1, 1), (day, 2, 1, 2)]


def test_refreshed_dwells_are_all_dwells(spark, tmp_path):
    old = [r for r in version(4, 1500)]
    new = edited(old, 4)
    changed = compared(spark, tmp_path, old, new)
    site = spark.createDataFrame([(1,), (2,), (9,)], "source_cell_id int")

    def dwells(rows):
        return dwell.dwells_from_events(dwell.events_at_site(spark.createDataFrame(rows, SCHEMA), site))
    got = refreshed_dwells(dwells(old), spark.createDataFrame(new, SCHEMA), site, changed)
    want = sorted(map(tuple, dwells(new).select(*dwell.DWELL_COLUMNS).collect()), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want and want
    assert want != sorted(map(tuple, dwells(old).select(*dwell.DWELL_COLUMNS).collect()), key=str)
