"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "headline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query runs to completion through a ``noop`` sink (no collect to the
driver); the set runs $BENCH_PASSES times (default 3) and each query reports
its fastest run.  ``value``
sums the headline queries (the four daily outputs plus the dwell steps);
``compare`` times each rewrite R1-R7 next to its literal join form.

The trace the jobs read is derived from ``events`` and written once per session
as a day-partitioned Parquet table (``sources/fixtures.py``), as it would be
stored in production; that one-time conversion falls in the first pass.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from footfall.operators import attachment as A  # noqa: E402
from footfall.operators import dwell as D  # noqa: E402
from footfall.operators import frequency as Q  # noqa: E402
from footfall.plans.catalog import QUERIES, Inputs  # noqa: E402
from footfall.session import local_session  # noqa: E402
from footfall.sources import dimensions as dims  # noqa: E402
from footfall.sources.fixtures import BAND_STEP_S, BANDS_PER_DAY, RUN_DATE  # noqa: E402
from footfall.sources.trace import trailing_window  # noqa: E402

HEADLINE = [
    "site_events", "micro_first_event", "micro_dwells", "dwells_islands", "dwells_as_reference",
    "user_frequency", "previous_events", "origin_msoa", "attachment_final", "partition_overwrite",
]


# user-day or date, as first written; each is timed next to the library's form.
def _lit_r1(spark, sf_dir):
    """Pairing self-join on (user, date) + min."""
    ev = Inputs(spark, sf_dir).site_events.select("user_id", "date_dt", "start_dt")
    a, b = ev.alias("a"), ev.alias("b")
    cond = ((F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.date_dt") == F.col("b.date_dt"))
            & (F.col("b.start_dt") >= F.col("a.start_dt") - F.expr("INTERVAL 45 MINUTES"))
            & (F.col("b.start_dt") <= F.col("a.start_dt") - F.expr("INTERVAL 1 MINUTE")))
    return (a.join(b, cond).groupBy("a.date_dt", "a.user_id", F.col("a.start_dt").alias("time_1"))
            .agg(F.min("b.start_dt").alias("first_event")))


def _new_r1(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return D.micro_first_events(i.site_events, i.p)


def _lit_r2(spark, sf_dir):
    """Links by self-join on (user, date) with counter_2 = counter + 1."""
    i = Inputs(spark, sf_dir)
    seq = D.micro_sequence(i.micro_written, i.p)
    a, b = seq.alias("a"), seq.alias("b")
    cond = ((F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.date_dt") == F.col("b.date_dt"))
            & (F.col("b.counter") - 1 == F.col("a.counter")) & (F.col("a.last_event") >= F.col("b.first_event")))
    return a.join(b, cond).select("a.*", F.col("b.first_event").alias("first_event_2"),
                                  F.col("b.last_event").alias("last_event_2"), F.col("b.counter").alias("counter_2"))


def _new_r2(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return D.macro_links(D.micro_sequence(i.micro_written, i.p), i.p)


def _lit_r3(spark, sf_dir):
    """Rail trips by joining rail events back to the dwells."""
    i = Inputs(spark, sf_dir)
    re_ = A.rail_events(i.previous, i.fx.rail_cell_table()).alias("r")
    dw = i.dwells.alias("d")
    cond = ((F.col("r.user_id") == F.col("d.user_id")) & (F.col("r.date_dt") == F.col("d.date_dt"))
            & (F.col("r.start_dt") < F.col("d.first_event"))
            & (F.col("r.start_dt") > F.col("d.first_event") - F.expr("INTERVAL 60 MINUTES")))
    return (re_.join(dw, cond).select("r.date_dt", "r.user_id", "d.first_event", "d.last_event").distinct()
            .withColumn("rail_trips", F.lit(1)))


def _new_r3(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return A.rail_trips(i.previous, i.fx.rail_cell_table(), i.p)


def _window(spark, sf_dir):
    i = Inputs(spark, sf_dir, "sparse")
    return i, trailing_window(i.dwells_table, RUN_DATE, i.p.trailing_days)


def _lit_r4(spark, sf_dir):
    """Visits per day, then sum and count of distinct days."""
    _, dw = _window(spark, sf_dir)
    per_day = dw.groupBy("date_dt", "user_id").agg(F.count(F.lit(1)).alias("visits"))
    return (per_day.groupBy("user_id").agg(F.sum("visits").alias("total_visits"),
                                           F.count_distinct("date_dt").alias("total_days"))
            .withColumn("commuters", F.when(F.col("total_visits") > 6, 1).otherwise(0)))


def _new_r4(spark, sf_dir):
    i, dw = _window(spark, sf_dir)
    return Q.user_frequency(dw, i.p)


def _lit_r5(spark, sf_dir):
    """Date-only resolution joining every macro dwell row (no dedup, no buckets)."""
    i = Inputs(spark, sf_dir)
    mi, ma = i.micro.alias("mi"), D.macro_dwells_from_events(i.site_events, i.p).alias("ma")
    cond = ((F.col("mi.date_dt") == F.col("ma.date_dt")) & (F.col("mi.first_event") <= F.col("ma.first_event"))
            & (F.col("mi.last_event") <= F.col("ma.last_event")))
    return mi.join(ma, cond, "left").select(
        "mi.date_dt", "mi.user_id", F.coalesce("ma.first_event", "mi.first_event").alias("first_event"),
        F.coalesce("ma.last_event", "mi.last_event").alias("last_event")).distinct()


def _new_r5(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return D.dwells(i.site_events, "as_reference", i.p)


def _lit_r6(spark, sf_dir):
    """Contained resolution: micro left join macro on (user, date) + containment."""
    i = Inputs(spark, sf_dir)
    mi, ma = i.micro.alias("mi"), D.macro_dwells_from_events(i.site_events, i.p).alias("ma")
    cond = ((F.col("mi.user_id") == F.col("ma.user_id")) & (F.col("mi.date_dt") == F.col("ma.date_dt"))
            & (F.col("mi.first_event") >= F.col("ma.first_event"))
            & (F.col("mi.last_event") <= F.col("ma.last_event")))
    return mi.join(ma, cond, "left").select(
        "mi.date_dt", "mi.user_id", F.coalesce("ma.first_event", "mi.first_event").alias("first_event"),
        F.coalesce("ma.last_event", "mi.last_event").alias("last_event")).distinct()


def _new_r6(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return D.dwells_from_events(i.site_events, i.p)


def _lit_r7(spark, sf_dir):
    """Bands by a broadcast theta join (nested loop)."""
    i = Inputs(spark, sf_dir)
    bands = dims.band_grid(i.fx.time_series_table(), i.trace).withColumnRenamed("date_dt", "band_date")
    cond = ((F.col("ts") > F.col("first_event")) & (F.col("last_event") > F.col("ts") - F.expr("INTERVAL 14 MINUTES"))
            & (F.col("band_date") == F.col("date_dt")))
    return i.dwells.join(F.broadcast(bands), cond).drop("band_date")


def _new_r7(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return A.band_occupancy_sequence(i.dwells, BAND_STEP_S, BANDS_PER_DAY, i.p)


COMPARE = {f"R{k}_{form}": fn for k in range(1, 8)
           for form, fn in (("literal", globals()[f"_lit_r{k}"]), ("rewrite", globals()[f"_new_r{k}"]))}


def run(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          app_name="footfall-bench")
    # Several passes over the whole set; each query keeps its fastest run (the
    # first pass also pays JIT compilation and file listing).
    times: dict[str, float] = {}
    compare: dict[str, float] = {}
    passes = int(os.environ.get("BENCH_PASSES", "3"))
    for _ in range(passes):
        for name in HEADLINE:
            times[name] = min(times.get(name, float("inf")), run(spark, QUERIES[name], sf_dir))
        for name, fn in COMPARE.items():
            compare[name] = min(compare.get(name, float("inf")), run(spark, fn, sf_dir))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "compare": compare,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "passes": passes,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
