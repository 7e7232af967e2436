"""Micro dwells of a stream against the batch operator, for several arrival orders within the delay."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest

from footfall.operators import dwell
from footfall.params import DEFAULT
from footfall.streaming.dwells import dwells_of_times, micro_dwells_stream

SCHEMA = "user_id bigint, date_dt date, start_dt timestamp_ntz, cell_id int, us string"
START = dt.datetime(2024, 1, 1, 20)
END = START + dt.timedelta(days=3)


def row(user, at):
    return (user, at.date() if at else None, at, 1, "clash")


def events(seed, n=240, hours=9):
    """Busy hours around midnight, gaps of exactly 45 min and 1 min, repeated events and nulls."""
    rnd = random.Random(seed)
    rows = []
    for user in (1, 2, 3):
        at = START
        while len([r for r in rows if r[0] == user]) < n // 3 and at < START + dt.timedelta(hours=hours):
            rows.append(row(user, at))
            at += dt.timedelta(seconds=rnd.choice([20, 59, 60, 61, 600, 1500, 2699, 2700, 2701, 5400]))
    return rows + rows[:7] + [row(None, START), row(1, None)]


def shuffled(rows, seed, delay_s=3600):
    """Rows by a time put off at random by less than the delay: no row is later than the watermark allows."""
    rnd = random.Random(seed)
    put_off = lambda r: (r[2] or START) + dt.timedelta(seconds=rnd.uniform(0, delay_s - 1))
    return [r for _, r in sorted(((put_off(r), r) for r in rows), key=lambda x: x[0])]


def streamed(spark, folder, arriving, files):
    """One micro batch per file; a last event far ahead closes what is open, and one more lets timers fire."""
    size = -(-len(arriving) // files)
    batches = [arriving[k:k + size] for k in range(0, len(arriving), size)]
    batches += [[row(77, END)], [row(77, END + dt.timedelta(days=1))]]
    source = f"{folder}/in"
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    for k, batch in enumerate(batches):
        # One folder, filled batch by batch; each run takes what has come, from where the last one stopped.
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        query = (micro_dwells_stream(stream, "1 hour").writeStream.format("parquet").option("path", f"{folder}/out")
                 .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination(120)
    return sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").collect())


@pytest.mark.parametrize("seed,files", [(1, 4), (2, 6)])
def test_any_order_within_the_delay_gives_the_batch(spark, tmp_path, seed, files):
    rows = events(seed)
    want = sorted(tuple(r) for r in dwell.micro_dwells(spark.createDataFrame(rows, SCHEMA))
                  .select("date_dt", "user_id", "first_event", "last_event").collect())
    (tmp_path / "in").mkdir()
    assert streamed(spark, str(tmp_path), shuffled(rows, seed), files) == want and len(want) > 10


def test_times_against_the_rule():
    """The rule read literally: earliest partner 45 to 1 min before on the same date, grouped by partner."""
    for seed in range(60):
        rnd = random.Random(seed)
        base = 86_400 * 20_000 - 3_000
        times = sorted({(base + 30 * rnd.randrange(250)) * 1_000_000 for _ in range(rnd.randrange(40))})
        want = {}
        for t in times:
            near = [u for u in times if 60 <= (t - u) / 1e6 <= 2700 and t // 86_400_000_000 == u // 86_400_000_000]
            if near:
                want[min(near)] = max(t, want.get(min(near), 0))
        first, last = dwells_of_times(np.array(times, dtype="int64"), DEFAULT)
        assert dict(zip(first.tolist(), last.tolist())) == want and len(first) == len(want)
