"""Tunable constants of the place analytics jobs.

Every rule of the jobs is a time offset or a threshold; they live here so
that operators take them as arguments instead of hard-coding them.
"""

from __future__ import annotations

from dataclasses import dataclass

MINUTE = 60
HOUR = 3600


@dataclass(frozen=True)
class Params:
    # These must equal the original jobs' rules for equal results.
    micro_max_gap_s: int = 45 * MINUTE   # earliest partner event: at most 45 min before
    micro_min_gap_s: int = 1 * MINUTE    # latest partner event: at least 1 min before
    lookback_s: int = 2 * HOUR           # "previous events": within 2 h before a dwell
    origin_min_lead_s: int = 15 * MINUTE  # origin events: more than 15 min before a dwell
    rail_recent_s: int = 60 * MINUTE     # rail trip: rail-cell event within 60 min before
    other_recent_s: int = 15 * MINUTE    # other trip: any event within 15 min before
    band_slack_s: int = 14 * MINUTE      # band occupied while last_event > band - 14 min
    trailing_days: int = 30              # visit-frequency window: run date - 30 days
    commuter_over: int = 6               # commuter: more than 6 visits in the window

    # Area code of the monitored place itself, excluded from origin candidates.
    excluded_area: str = "M0"

    # Skew splitting: per-user-day sequences are cut into time buckets of this
    # width (plus a halo of neighbouring rows), so one very busy user-day is
    # spread over many tasks instead of landing in one.  Must be at least the
    # largest look-back that the bucketed operator uses.
    bucket_s: int = 2 * HOUR
    # All pairs of events (look-back 45 min) are joined in buckets of this width: rows that meet
    # are 1.2 times the pairs, and an event is copied into 5 or 6 buckets.
    pair_bucket_s: int = 10 * MINUTE
    # Interval joins against the 2 h look-back use buckets of this width.
    lookback_bucket_s: int = 2 * HOUR

    def __post_init__(self) -> None:
        if self.bucket_s < self.micro_max_gap_s:
            raise ValueError("bucket_s must be >= micro_max_gap_s")
        if self.micro_min_gap_s > self.micro_max_gap_s:
            raise ValueError("micro_min_gap_s must be <= micro_max_gap_s")
        # Rail trips are read from the previous-event pairs instead of joining the
        # rail events back to every dwell; that is exact while the rail window
        # lies inside the look-back.
        if self.rail_recent_s > self.lookback_s:
            raise ValueError("rail_recent_s must be <= lookback_s")


DEFAULT = Params()
