"""Trailing-window partition selection and the idempotent sink."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.functions.timecols import day_parts
from footfall.plans import sinks
from footfall.sources.trace import scan_day, trailing_window


def _days(spark, start: str, n: int):
    d0 = dt.date.fromisoformat(start)
    df = spark.createDataFrame([(d0 + dt.timedelta(days=k),) for k in range(n)], "date_dt date")
    return df.withColumns(day_parts("date_dt"))


@pytest.mark.parametrize("run, componentwise_days", [
    ("2024-01-31", 31), ("2024-01-30", 0), ("2019-03-15", 6), ("2019-11-15", 0)])
def test_window_modes(spark, run, componentwise_days):
    days = _days(spark, "2018-12-01", 500).unionByName(_days(spark, "2023-12-01", 80))
    assert trailing_window(days, run, 30).count() == 31
    assert trailing_window(days, run, 30, "componentwise").count() == componentwise_days


def test_overwrite_replaces_only_its_day(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "user_id bigint, date_dt date")
    sinks.overwrite_partitions(sinks.stamp_by_date(df, "2024-01-31 06:00:00"), path, ["date_dt", "user_id"])
    again = spark.createDataFrame([(3, dt.date(2024, 1, 2))], "user_id bigint, date_dt date")
    sinks.overwrite_partitions(sinks.stamp_partition(again, "2024-01-02", "2024-02-01 00:00:00"), path,
                               ["date_dt", "user_id"])
    back = sinks.read_table(spark, path)
    assert back.columns == ["date_dt", "user_id", "load_timestamp", "year", "month", "day"]
    assert {f.name: f.dataType.simpleString() for f in back.schema}["day"] == "string"
    got = sorted((r["user_id"], r["day"]) for r in back.collect())
    assert got == [(1, "01"), (3, "02")]
    summary = {r["day"]: r["record_count"] for r in sinks.load_summary(back).collect()}
    assert summary == {"01": 1, "02": 1}
    assert scan_day(back, "2024-01-02").where(F.col("user_id") == 3).count() == 1


def test_checkpoint_dir_created_only_when_unset(tmp_path):
    from footfall.session import ensure_checkpoint_dir

    class _Ctx:
        def __init__(self, d, master="local[2]"):
            self.d, self.master = d, master

        def getCheckpointDir(self):
            return self.d

        def setCheckpointDir(self, d):
            self.d = d

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Session:
        def __init__(self, d):
            self.sparkContext, self.conf = _Ctx(d), _Conf()

    shared = str(tmp_path / "shared")
    assert ensure_checkpoint_dir(_Session(shared)) == shared          # named by the cluster: kept
    fresh = _Session(None)
    made = ensure_checkpoint_dir(fresh)
    assert made and fresh.sparkContext.getCheckpointDir() == made     # unset: private folder
