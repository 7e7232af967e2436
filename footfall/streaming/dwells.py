"""Micro dwells of a stream, each emitted once, when nothing that may still arrive can change it.

Events come in any order within the watermark's delay.  The state of a user is the times of the events that an open
dwell may still need: those since ``watermark - 2 * micro_max_gap``.  A dwell that starts at ``f`` depends on events
from ``f - micro_max_gap`` to ``f + micro_max_gap`` only, so it is final once the watermark is past the
latter; an event-time timer wakes users whose last dwell is still open when no event of theirs follows.
Since times are whole seconds, a state holds at most the seconds of twice the gap and the delay, however many events
a user has.  Events that come later than the delay are dropped, as by any watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.timecols import epoch_us
from ..params import DEFAULT, Params

US = 1_000_000
DAY_US = 86_400 * US
OUT = "user_id bigint, first_us bigint, last_us bigint"


def dwells_of_times(times: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """First and last event (epoch microseconds) of the micro dwells of one user's sorted distinct times."""
    # The earliest partner: not before the look-back, nor before the event's date.
    earliest = np.maximum(times - p.micro_max_gap_s * US, times - times % DAY_US)
    partner = times[np.searchsorted(times, earliest)] if len(times) else times
    paired = partner <= times - p.micro_min_gap_s * US
    first, members = partner[paired], times[paired]
    # Partners do not go back as times go on: the last member of a run is the dwell's end.
    ends = np.append(first[1:] != first[:-1], True)[:len(first)]
    return first[ends], members[ends]


def _step(p: Params):
    gap = p.micro_max_gap_s * US

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Before the first watermark nothing is final.
        mark = max(state.getCurrentWatermarkMs(), 0) * 1000
        seen, done = state.get if state.exists else ([], -1)
        parts = [np.asarray(seen, dtype="int64")] + [b["us"].to_numpy("int64") for b in batches]
        times = np.unique(np.concatenate(parts))
        first, last = dwells_of_times(times, p)
        final = (first > done) & (first + gap < mark)
        open_since = mark - gap
        if len(times) and times[-1] >= open_since:
            kept = times[times >= open_since - gap]
            state.update(([int(t) for t in kept], max(done, open_since - 1)))
            oldest_open = int(kept[np.searchsorted(kept, open_since)])
            state.setTimeoutTimestamp((oldest_open + gap) // 1000 + 1)
        elif state.exists:
            state.remove()
        if final.any():
            yield pd.DataFrame({"user_id": key[0], "first_us": first[final], "last_us": last[final]})

    return step


def micro_dwells_stream(site_events: DataFrame, delay: str = "2 hours", p: Params = DEFAULT) -> DataFrame:
    """``date_dt, user_id, first_event, last_event`` of a stream of site events (``user_id, start_dt``), in append mode.

    Over all events the rows are those of ``dwell.micro_dwells``, but for the dwells still open when the stream
    ends.  Events without user or time are ignored, repeated ones change nothing.
    """
    events = (site_events.where("user_id is not null and start_dt is not null")
              .select("user_id", F.col("start_dt").cast("timestamp").alias("at"), epoch_us("start_dt").alias("us"))
              .withWatermark("at", delay))
    found = events.groupBy("user_id").applyInPandasWithState(
        _step(p), OUT, "seen array<bigint>, done bigint", "append", GroupStateTimeout.EventTimeTimeout)
    first = F.timestamp_micros("first_us").cast("timestamp_ntz")
    return found.select(F.to_date(first).alias("date_dt"), "user_id", first.alias("first_event"),
                        F.timestamp_micros("last_us").cast("timestamp_ntz").alias("last_event"))
