"""Bucketed, skew-split forms equal the plain per-user-day forms.

Seeded random traces with a deliberately hot user; bucket widths as small as
the rules allow so that many sequences cross bucket edges.
"""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.functions.timecols import epoch_us
from footfall.operators import dwell as D
from footfall.operators import origin as O
from footfall.params import Params


def _events(spark, seed: int, n: int = 3000):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 15)
    rows = []
    for _ in range(n):
        user = 0 if rnd.random() < 0.4 else rnd.randrange(1, 8)   # user 0 holds ~40 % of rows
        day = rnd.randrange(2)
        sec = rnd.randrange(0, 86400)
        t = base + dt.timedelta(days=day, seconds=sec)
        rows.append((user, t.date(), t, rnd.randrange(3)))
    return spark.createDataFrame(rows, "user_id bigint, date_dt date, start_dt timestamp_ntz, cell_id int")


def _plain_first_events(ev, p):
    w = (Window.partitionBy("user_id", "date_dt").orderBy("_us")
         .rangeBetween(-p.micro_max_gap_s * 10**6, -p.micro_min_gap_s * 10**6))
    return (ev.withColumn("_us", epoch_us("start_dt"))
            .withColumn("first_event", F.min("start_dt").over(w))
            .where(F.col("first_event").isNotNull())
            .select("date_dt", "user_id", F.col("start_dt").alias("time_1"), "first_event").distinct())


def _same(a, b):
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bucket_s", [2700, 3600, 7200])
def test_first_events_bucketed_equals_plain(spark, seed, bucket_s):
    p = Params(bucket_s=bucket_s)
    ev = _events(spark, seed)
    _same(D.micro_first_events(ev, p), _plain_first_events(ev, p))
    pairs = D.micro_pairs(ev, p).groupBy("date_dt", "user_id", "time_1").agg(F.min("time_2").alias("first_event"))
    _same(D.micro_first_events(ev, p), pairs)


def test_pairs_equal_plain_join_without_interval_arithmetic(spark):
    base = dt.datetime(2024, 1, 15, 9, 0, 0)
    rows = [(u, (base + dt.timedelta(seconds=s)).date(), base + dt.timedelta(seconds=s))
            for u in (1, None) for s in (0, 0, 59, 60, 600, 2700, 2701, 3300, 5400, 54000, 55000, 55060)]
    ev = spark.createDataFrame(rows, "user_id long, date_dt date, start_dt timestamp_ntz")
    a, b = ev.alias("a"), ev.alias("b")
    plain = a.join(b, F.expr("a.user_id = b.user_id and a.date_dt = b.date_dt and b.start_dt >= a.start_dt - interval "
                             "2700 second and b.start_dt <= a.start_dt - interval 60 second"))
    pairs = D.micro_pairs(ev)
    _same(pairs, plain.selectExpr("a.date_dt", "a.user_id", "a.start_dt as time_1", "b.start_dt as time_2"))
    # Arithmetic on timestamps for every two rows that meet took most of the time.
    assert "INTERVAL" not in pairs._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("bucket_s", [2700, 5400])
def test_dwell_forms_agree(spark, bucket_s):
    p = Params(bucket_s=bucket_s)
    micro = D.micro_dwells(_events(spark, 3), p)
    seq = D.micro_sequence(micro, p)
    plain_seq = micro.withColumn(
        "counter", F.row_number().over(Window.partitionBy("user_id", "date_dt").orderBy("first_event")))
    _same(seq, plain_seq.select(*seq.columns))
    macro_literal = D.macro_dwells_from_islands(D.macro_islands(D.macro_links(seq, p), p)) \
        .select("date_dt", "user_id", "first_event", "last_event")
    _same(D.macro_dwells(micro, p), macro_literal)
    _same(D.dwell_islands(micro, p), D.resolve_contained(micro, macro_literal, p))


def test_previous_events_bucketed_equals_plain(spark):
    p = Params()
    ev = _events(spark, 4)
    dw = D.dwell_islands(D.micro_dwells(ev, p), p)
    plain = (ev.alias("e").join(dw.alias("d"), ["user_id", "date_dt"])
             .where((F.col("e.start_dt") < F.col("d.first_event"))
                    & (F.col("e.start_dt") > F.col("d.first_event") - F.expr("INTERVAL 2 HOURS")))
             .select("date_dt", "user_id", "e.start_dt", "e.cell_id", "d.first_event", "d.last_event"))
    _same(O.previous_events(ev, dw, p), plain)


def test_hot_user_is_split_over_buckets(spark):
    ev = _events(spark, 5)
    groups = (D.event_stage(ev).where("user_id = 0 AND _own")
              .select("date_dt", "_bucket").distinct().count())
    assert groups >= 20          # two days, 12 two-hour buckets each


def test_partition_sizing(spark):
    from footfall.session import configure_for_input
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert configure_for_input(spark, 3 * 1024**4) > 40_000     # 3 TiB day
        assert configure_for_input(spark, 10 * 1024**2) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionFactor")


@pytest.mark.parametrize("width_s, how", [(60, "inner"), (600, "left"), (7200, "left"), (45, "inner")])
def test_bucketed_range_join_equals_plain_join(spark, width_s, how):
    from footfall.operators.intervals import bucketed_range_join
    rnd = random.Random(width_s)
    base = dt.datetime(2024, 1, 15)
    points = [(rnd.randrange(3), base + dt.timedelta(seconds=rnd.randrange(7200))) for _ in range(400)]
    points += points[:20]                                     # duplicates keep their multiplicity
    ranges = []
    for _ in range(120):
        lo = rnd.randrange(7200)
        ranges.append((rnd.randrange(3), base + dt.timedelta(seconds=lo),
                       base + dt.timedelta(seconds=lo + rnd.randrange(1, 1800))))
    p = spark.createDataFrame(points, "k bigint, t timestamp_ntz")
    r = spark.createDataFrame(ranges, "k bigint, lo timestamp_ntz, hi timestamp_ntz")
    cond = (F.col("p.t") >= F.col("r.lo")) & (F.col("p.t") <= F.col("r.hi"))
    got = bucketed_range_join(p, r, ["k"], epoch_us("t"), epoch_us("lo"), epoch_us("hi"),
                              width_s * 10**6, cond, how).select("p.k", "p.t", "r.lo", "r.hi")
    plain = p.alias("p").join(r.alias("r"), (F.col("p.k") == F.col("r.k")) & cond, how) \
        .select("p.k", "p.t", "r.lo", "r.hi")
    _same(got, plain)


@pytest.mark.parametrize("width, back, ahead", [(100, 30, 0), (100, 250, 40), (60, 0, 60), (10, 35, 5)])
def test_with_halo_copies_exactly_the_needed_buckets(spark, width, back, ahead):
    from footfall.functions.buckets import with_halo
    rnd = random.Random(width + back)
    values = [rnd.randrange(0, 2000) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, _us long")
    got = {(r["id"], r["_bucket"], r["_own"]) for r in with_halo(df, "_us", width, back, ahead).collect()}
    want = set()
    for i, v in enumerate(values):
        own = v // width
        for b in range((v - ahead) // width, (v + back) // width + 1):
            want.add((i, b, b == own))
    assert got == want
    # each row keeps exactly one own copy; a copy in bucket b is within the halo of b's rows
    assert sum(1 for (_, _, o) in got if o) == len(values)
    for i, b, o in got:
        v = values[i]
        assert o or (b * width - back <= v < b * width) or ((b + 1) * width <= v < (b + 1) * width + ahead)
