"""The daily run over Parquet tables written from the sf0.001 fixture."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from footfall.plans.catalog import QUERIES
from footfall.plans.daily_run import Outputs, run_day
from footfall.sources.fixtures import Fixture
from footfall.sources.tables import Tables, read_output
from footfall.streaming.daily import start_daily_loads

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
DAY = "2024-01-15"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    fx = Fixture(spark, SF)
    fx.raw_trace().write.partitionBy("year", "month", "day").parquet(str(root / "trace"))
    fx.site_cell_table().write.parquet(str(root / "site"))
    fx.area_cell_table().write.parquet(str(root / "area"))
    fx.rail_cell_table().write.parquet(str(root / "rail"))
    fx.time_series_table().write.parquet(str(root / "bands"))
    return Tables(str(root / "trace"), str(root / "site"), str(root / "area"), str(root / "rail"),
                  str(root / "bands"))


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_run_day_matches_queries(spark, tables, tmp_path):
    out = Outputs(str(tmp_path / "out"))
    counts = run_day(spark, tables, out, DAY, "2024-01-31 06:00:00")
    dwells = read_output(spark, out.path("dwells"), "dwells")
    cols = ["date_dt", "user_id", "first_event", "last_event"]
    expect = QUERIES["dwells_of_day"](spark, SF)
    assert _rows(dwells, cols) == _rows(expect, cols)
    assert counts["dwells"] == dwells.count()

    origin = read_output(spark, out.path("origin_msoa"), "origin_msoa")
    day_origin = QUERIES["origin_msoa"](spark, SF).where(F.col("date_dt") == F.lit(DAY).cast("date"))
    ocols = ["date_dt", "user_id", "first_event", "last_known_event", "origin_msoa"]
    assert _rows(origin, ocols) == _rows(day_origin, ocols)

    att = read_output(spark, out.path("users_attachment"), "users_attachment")
    day_att = QUERIES["attachment_final"](spark, SF).where(F.col("date_dt") == F.lit(DAY).cast("date"))
    acols = ["date_dt", "timeband", "user_id", "first_event", "last_event", "dwell_time", "rail_trips",
             "other_trips", "tube_trips"]
    assert _rows(att, acols) == _rows(day_att, acols)
    assert counts["users_attachment"] == att.count()

    users = read_output(spark, out.path("users"), "users")
    assert counts["users"] == users.count() == dwells.select("user_id").distinct().count()


def test_rerun_is_idempotent(spark, tables, tmp_path):
    out = Outputs(str(tmp_path / "out"))
    first = run_day(spark, tables, out, DAY, "2024-01-31 06:00:00")
    again = run_day(spark, tables, out, DAY, "2024-02-01 06:00:00")
    assert first == again
    dwells = read_output(spark, out.path("dwells"), "dwells")
    assert dwells.count() == first["dwells"]
    assert {r[0] for r in dwells.select(F.col("load_timestamp").cast("string")).distinct().collect()} == \
        {"2024-02-01 06:00:00"}


def test_empty_rerun_empties_the_day(spark, tables, tmp_path):
    out = Outputs(str(tmp_path / "out"))
    run_day(spark, tables, out, "2024-01-14", "2024-01-31 06:00:00")
    kept = read_output(spark, out.path("dwells"), "dwells").count()
    run_day(spark, tables, out, DAY, "2024-01-31 06:00:00")
    none = str(tmp_path / "no-cells")
    spark.read.parquet(tables.site_cells).where("false").write.parquet(none)
    bare = Tables(tables.trace, none, tables.area_cells, tables.rail_cells, tables.time_series)
    counts = run_day(spark, bare, out, DAY, "2024-02-01 06:00:00")
    assert counts["dwells"] == counts["origin_msoa"] == counts["users_attachment"] == 0
    for name in ("dwells", "origin_msoa", "users_attachment"):
        assert read_output(spark, out.path(name), name).where("day = '15'").count() == 0
    assert read_output(spark, out.path("dwells"), "dwells").count() == kept


def test_stream_trigger_loads_each_new_day(spark, tables, tmp_path):
    out = Outputs(str(tmp_path / "out"))
    trace_two_days = str(tmp_path / "trace2")
    spark.read.parquet(tables.trace).where("day in ('14', '15')") \
        .write.partitionBy("year", "month", "day").parquet(trace_two_days)
    t2 = Tables(trace_two_days, tables.site_cells, tables.area_cells, tables.rail_cells, tables.time_series)
    q = start_daily_loads(spark, t2, out, str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    days = {r["day"] for r in read_output(spark, out.path("dwells"), "dwells").select("day").distinct().collect()}
    assert days == {"14", "15"}


def test_run_day_original_modes(spark, tables, tmp_path):
    out = Outputs(str(tmp_path / "out"))
    counts = run_day(spark, tables, out, DAY, "2024-01-31 06:00:00", dwell_mode="as_reference",
                     window_mode="componentwise", keep_unknown_origin=True, zero_fill_rail=True)
    dwells = read_output(spark, out.path("dwells"), "dwells")
    cols = ["date_dt", "user_id", "first_event", "last_event"]
    expect = QUERIES["dwells_as_reference"](spark, SF).where(F.col("date_dt") == F.lit(DAY).cast("date"))
    assert _rows(dwells, cols) == _rows(expect, cols)
    origin = read_output(spark, out.path("origin_msoa"), "origin_msoa")
    assert counts["origin_msoa"] == origin.count() == counts["dwells"]
    att = read_output(spark, out.path("users_attachment"), "users_attachment")
    assert att.where("rail_trips IS NULL").count() == 0


def test_stream_trigger_loads_new_days_once(spark, tables, tmp_path):
    import time
    out = Outputs(str(tmp_path / "out"))
    landing = str(tmp_path / "landing")
    ckpt = str(tmp_path / "ckpt")
    src = spark.read.parquet(tables.trace)
    src.where("day = '14'").write.partitionBy("year", "month", "day").parquet(landing)
    t2 = Tables(landing, tables.site_cells, tables.area_cells, tables.rail_cells, tables.time_series)
    start_daily_loads(spark, t2, out, ckpt).awaitTermination(300)
    first = {r["day"]: r["ts"] for r in read_output(spark, out.path("dwells"), "dwells")
             .groupBy("day").agg(F.max("load_timestamp").alias("ts")).collect()}
    assert set(first) == {"14"}
    time.sleep(1.1)                                  # load timestamps are whole seconds
    src.where("day = '15'").write.mode("append").partitionBy("year", "month", "day").parquet(landing)
    start_daily_loads(spark, t2, out, ckpt).awaitTermination(300)
    second = {r["day"]: r["ts"] for r in read_output(spark, out.path("dwells"), "dwells")
              .groupBy("day").agg(F.max("load_timestamp").alias("ts")).collect()}
    assert set(second) == {"14", "15"}
    assert second["14"] == first["14"]               # day 14 was not loaded again


def test_stream_trigger_reloads_a_day_when_late_files_land(spark, tables, tmp_path):
    import time
    out = Outputs(str(tmp_path / "out"))
    landing = str(tmp_path / "landing")
    ckpt = str(tmp_path / "ckpt")
    day14 = spark.read.parquet(tables.trace).where("day = '14'")
    early, late = day14.where("imsi % 2 = 0"), day14.where("imsi % 2 = 1")
    early.write.partitionBy("year", "month", "day").parquet(landing)
    t2 = Tables(landing, tables.site_cells, tables.area_cells, tables.rail_cells, tables.time_series)
    start_daily_loads(spark, t2, out, ckpt).awaitTermination(300)
    first = read_output(spark, out.path("dwells"), "dwells").count()
    time.sleep(1.1)
    late.write.mode("append").partitionBy("year", "month", "day").parquet(landing)
    start_daily_loads(spark, t2, out, ckpt).awaitTermination(300)
    dwells = read_output(spark, out.path("dwells"), "dwells")
    expect = QUERIES["dwells_islands"](spark, SF).where(F.col("date_dt") == F.lit("2024-01-14").cast("date"))
    cols = ["date_dt", "user_id", "first_event", "last_event"]
    # The whole day was recomputed from all its files, replacing the first load.
    assert _rows(dwells, cols) == _rows(expect, cols)
    assert dwells.select("load_timestamp").distinct().count() == 1
    assert dwells.count() >= first
