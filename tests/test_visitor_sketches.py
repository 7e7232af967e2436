"""Visitor sketches against exact counts: exact up to K users, within the stated error above."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.operators.visitor_sketches import area_day_sketches, returning_visitors

FIRST, SECOND = ("2024-01-01", "2024-01-05"), ("2024-01-06", "2024-01-10")


def trace(spark, users):
    """Day ``d`` sees users from ``d * users / 10`` on; cell 1 all of them, cell 2 every third."""
    rows = spark.range(10).select(F.col("id").alias("d")).join(spark.range(users).select(F.col("id").alias("user_id")),
                                                               F.expr("user_id >= d * {} / 10".format(users)))
    return rows.select(
        F.expr("date_add(date'2024-01-01', cast(d as int))").alias("date_dt"), "user_id", F.lit("x").alias("sketch"),
        F.explode(F.expr("if(user_id % 3 = 0, array(1, 2), array(1))")).alias("cell_id"))


def areas(spark):
    return spark.createDataFrame([(1, "A"), (1, "A"), (2, "B"), (3, "C"), (None, "D")], "source_cell_id int, msoa string")


def exact(users):
    everyone, later = users, users - users // 2
    third = lambda n, lo: len([u for u in range(lo, n) if u % 3 == 0])
    return {"A": (everyone, later, later, everyone),
            "B": (third(users, 0), third(users, users // 2), third(users, users // 2), third(users, 0))}


def counted(spark, users):
    out = returning_visitors(area_day_sketches(trace(spark, users), areas(spark)), FIRST, SECOND)
    assert out.columns == ["msoa", "visitors_first", "visitors_second", "returning", "visitors"]
    return {r[0]: tuple(r)[1:] for r in out.collect()}


def test_exact_below_k(spark):
    assert counted(spark, 2000) == exact(2000)


@pytest.mark.parametrize("users", [20_000, 60_000])
def test_error_bound_above_k(spark, users):
    got, want = counted(spark, users), exact(users)
    for area, counts in want.items():
        for k, (g, w) in enumerate(zip(got[area], counts)):
            stretch = (counts[3] / w) ** 0.5 if k == 2 else 1
            assert abs(g - w) <= 4 * stretch * w / (4096 - 1) ** 0.5, (area, k, g, w)


def test_one_range_nulls_and_nothing(spark):
    rows = [(dt.date(2024, 1, 1), 7, 1), (dt.date(2024, 1, 1), None, 1), (None, 8, 1), (dt.date(2024, 1, 7), 7, 2),
            (dt.date(2024, 1, 7), 8, None), (dt.date(2024, 2, 1), 9, 1)]
    t = spark.createDataFrame(rows, "date_dt date, user_id bigint, cell_id int")
    got = returning_visitors(area_day_sketches(t, areas(spark)), FIRST, SECOND).collect()
    assert sorted(map(tuple, got)) == [("A", 1, 0, 0, 1), ("B", 0, 1, 0, 1)]
    assert returning_visitors(area_day_sketches(t.where("false"), areas(spark)), FIRST, SECOND).count() == 0
