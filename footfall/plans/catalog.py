"""Named queries over the driver tables: one per operator of the jobs.

``QUERIES[name](spark, sf_dir)`` builds the Spark plan; ``ORACLES[name]`` is
the same question in DuckDB SQL, written in the literal form of the original
jobs (self-joins, date-only theta join, row_number top-1) so that a match also
shows the scalable rewrite to be equal.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import asof
from ..operators import attachment as A
from ..operators import changes
from ..operators import dominance
from ..operators import dwell as D
from ..operators import frequency as Q
from ..operators import frequency_state as FS
from ..operators import headcount as H
from ..operators import origin as O
from ..operators import patterns
from ..operators import visitor_sketches as V
from ..params import Params
from ..sources import dimensions as dims
from ..sources.fixtures import (BAND_STEP_S, BANDS_PER_DAY, LOAD_TS, MAPPINGS, RUN_DATE, RUN_DAY, Fixture,
                                sql_views)
from ..sources.trace import normalise_trace, scan_day, trailing_window
from . import sinks

RELOAD_TS = "2024-02-01 06:00:00"   # load time of the re-run day in partition_overwrite


class Inputs:
    """Fixture tables and shared intermediate results of one mapping."""

    def __init__(self, spark: SparkSession, sf_dir: str, mapping: str = "dense"):
        self.spark = spark
        self.fx = Fixture(spark, sf_dir, mapping)
        self.p = Params(excluded_area=self.fx.excluded_area)

    @cached_property
    def raw(self) -> DataFrame:
        return self.fx.raw_trace()

    @cached_property
    def trace(self) -> DataFrame:
        return normalise_trace(self.raw)

    @cached_property
    def site_events(self) -> DataFrame:
        return D.events_at_site(self.trace, self.fx.site_cell_table())

    @cached_property
    def micro(self) -> DataFrame:
        return D.micro_dwells(self.site_events, self.p)

    @cached_property
    def dwells(self) -> DataFrame:
        return D.dwells_from_events(self.site_events, self.p)

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once to a scratch table under the checkpoint folder and
        read back, for queries whose branches all start from it."""
        path = sinks.scratch_table_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def dwells_written(self) -> DataFrame:
        return self._written(self.dwells, "dwells-shared")

    @cached_property
    def micro_written(self) -> DataFrame:
        return self._written(self.micro, "micro-shared")

    @cached_property
    def dwells_table(self) -> DataFrame:
        return sinks.stamp_by_date(self.dwells, LOAD_TS)

    @cached_property
    def users(self) -> DataFrame:
        return Q.visit_frequency(self.dwells_table, RUN_DATE, self.p)

    @cached_property
    def previous(self) -> DataFrame:
        return O.previous_events(self.trace, self.dwells_written, self.p)

    def origin(self, keep_unknown: bool = False) -> DataFrame:
        top = O.origin_top_cell(O.origin_candidates(self.previous, self.fx.area_cell_table(), self.p))
        return O.visitor_origin(self.dwells_written, top, self.fx.area_cell_table(), keep_unknown)

    @cached_property
    def joined(self) -> DataFrame:
        dw = self.dwells_written
        flags = A.arrival_flags(self.previous, self.fx.rail_cell_table(), self.p)
        users = Q.visit_frequency(sinks.stamp_by_date(dw, LOAD_TS), RUN_DATE, self.p)
        return A.attachment_joined(dw, users, flags)


def _dense(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Inputs(spark, sf_dir, "dense"))


def _sparse(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Inputs(spark, sf_dir, "sparse"))


def _partition_overwrite(i: Inputs) -> DataFrame:
    """Write every day, re-run one day with a new load time, read the table back."""
    path = sinks.scratch_table_path(i.spark, "dwells")
    cols = sinks.OUTPUT_COLUMNS["dwells"]
    sinks.overwrite_partitions(sinks.stamp_by_date(i.dwells_written, LOAD_TS), path, cols)
    rerun = sinks.stamp_partition(i.dwells_written.where(F.col("date_dt") == F.lit(RUN_DAY).cast("date")),
                                  RUN_DAY, RELOAD_TS)
    sinks.overwrite_partitions(rerun, path, cols)
    return sinks.read_table(i.spark, path)


#: Consecutive run dates of frequency_incremental: days enter the window, then leave it again.
STATE_DAYS = [dt.date(2024, 1, 15) + dt.timedelta(days=k) for k in range(31)]


def _frequency_incremental(i: Inputs) -> DataFrame:
    """The frequency of 31 consecutive run dates, each from its day and the state of the day before."""
    path = sinks.scratch_table_path(i.spark, "dwells")
    sinks.overwrite_partitions(sinks.stamp_by_date(i.dwells, LOAD_TS), path, sinks.OUTPUT_COLUMNS["dwells"])
    dwells, state = sinks.read_table(i.spark, path), sinks.scratch_table_path(i.spark, "frequency-states")
    runs = [FS.advance(dwells, state, day, i.p).withColumn("run_date", F.lit(day)) for day in STATE_DAYS]
    return reduce(DataFrame.unionByName, runs)


#: The later version of the trace: on every fifth day, for a third of the users, some rows are gone, moved or doubled.
EDITED = "day(date_dt) % 5 = 0 AND user_id % 3 = 1"
GONE, MOVED, DOUBLED = (f"{EDITED} AND second(start_dt) % 10 = {s}" for s in (3, 4, 5))


def _edited_trace(i: Inputs) -> DataFrame:
    rows = i.trace.where(f"NOT coalesce({GONE}, false)")
    moved = rows.withColumn("cell_id", F.expr(f"CASE WHEN {MOVED} THEN cell_id + 1 ELSE cell_id END"))
    return moved.unionByName(rows.where(DOUBLED))


def _changed_user_days(i: Inputs) -> DataFrame:
    paths = []
    for name, trace in (("before", i.trace), ("after", _edited_trace(i))):
        paths.append(sinks.scratch_table_path(i.spark, f"tree-{name}"))
        changes.write_tree(trace, paths[-1])
    return changes.changed_user_days(i.spark, *paths)


def _dwells_refreshed(i: Inputs) -> DataFrame:
    return changes.refreshed_dwells(i.dwells_written, _edited_trace(i), i.fx.site_cell_table(), _changed_user_days(i), i.p)


#: The two periods of visitors_returning.
PERIODS = (("2024-01-01", "2024-01-14"), ("2024-01-15", "2024-01-30"))


def _visitors_returning(i: Inputs) -> DataFrame:
    sketches = i._written(V.area_day_sketches(i.trace, i.fx.area_cell_table()), "area-sketches")
    return V.returning_visitors(sketches, *PERIODS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources and dimensions
    "scan_day": _dense(lambda i: scan_day(i.raw, RUN_DAY)),
    "trace_normalised": _dense(lambda i: i.trace),
    "site_cells": _dense(lambda i: dims.site_cells(i.fx.site_cell_table())),
    "area_cells": _dense(lambda i: dims.area_cells(i.fx.area_cell_table())),
    "area_cells_excluding_site": _dense(
        lambda i: dims.area_cells_excluding(i.fx.area_cell_table(), i.p.excluded_area)),
    "rail_cells": _dense(lambda i: dims.rail_cells(i.fx.rail_cell_table())),
    "time_bands": _dense(lambda i: dims.band_grid(i.fx.time_series_table(), i.trace)),
    # dwells
    "site_events": _dense(lambda i: i.site_events),
    "micro_pairs": _dense(lambda i: D.micro_pairs(i.site_events, i.p)),
    "micro_first_event": _dense(lambda i: D.micro_first_events(i.site_events, i.p)),
    "micro_dwells": _dense(lambda i: i.micro),
    "micro_sequence": _dense(lambda i: D.micro_sequence(i.micro_written, i.p)),
    "macro_links": _dense(lambda i: D.macro_links(D.micro_sequence(i.micro_written, i.p), i.p)),
    "macro_islands": _dense(
        lambda i: D.macro_islands(D.macro_links(D.micro_sequence(i.micro_written, i.p), i.p), i.p)),
    "macro_dwells": _dense(lambda i: D.macro_dwells_from_events(i.site_events, i.p)),
    "dwells_contained": _dense(lambda i: D.resolve_contained(
        i.micro_written, D.macro_dwells(i.micro_written, i.p), i.p)),
    "dwells_as_reference": _dense(lambda i: D.resolve_as_reference(
        i.micro_written, D.macro_dwells(i.micro_written, i.p), i.p)),
    "dominating_macros": _dense(lambda i: dominance.dominating_macros(i.micro_written, D.macro_dwells(i.micro_written, i.p))),
    "dwells_islands": _dense(lambda i: i.dwells),
    "dwells_of_day": _dense(lambda i: scan_day(i.dwells_table, RUN_DAY)),
    # visit frequency
    "window_trailing": _dense(lambda i: trailing_window(i.dwells_table, RUN_DATE, i.p.trailing_days)),
    "window_componentwise": _dense(
        lambda i: trailing_window(i.dwells_table, RUN_DATE, i.p.trailing_days, "componentwise")),
    "user_day_visits": _sparse(lambda i: Q.user_day_visits(i.dwells)),
    "user_frequency": _sparse(lambda i: i.users),
    "user_frequency_componentwise": _sparse(
        lambda i: Q.visit_frequency(i.dwells_table, RUN_DATE, i.p, "componentwise")),
    "frequency_incremental": _sparse(_frequency_incremental),
    "visitors_returning": _sparse(_visitors_returning),
    # changes between versions
    "changed_user_days": _dense(_changed_user_days),
    "dwells_refreshed": _dense(_dwells_refreshed),
    # origin
    "previous_events": _dense(lambda i: i.previous),
    "last_event_before": _dense(lambda i: asof.last_event_before(i.trace, i.dwells_written, i.p)),
    "origin_candidates": _dense(lambda i: O.origin_candidates(i.previous, i.fx.area_cell_table(), i.p)),
    "origin_top_cell": _dense(
        lambda i: O.origin_top_cell(O.origin_candidates(i.previous, i.fx.area_cell_table(), i.p))),
    "origin_msoa": _dense(lambda i: i.origin()),
    "origin_msoa_keep_unknown": _dense(lambda i: i.origin(keep_unknown=True)),
    # arrival mode and attachment
    "rail_events": _dense(lambda i: A.rail_events(i.previous, i.fx.rail_cell_table())),
    "arrival_paths": _dense(lambda i: patterns.arrival_paths(i.trace, i.fx.site_cell_table(), i.fx.rail_cell_table(), i.p)),
    "rail_trips": _dense(lambda i: A.rail_trips(i.previous, i.fx.rail_cell_table(), i.p)),
    "other_trips": _dense(lambda i: A.other_trips(i.previous, i.p)),
    "band_occupancy": _dense(lambda i: A.band_occupancy(i.dwells, i.fx.time_series_table(), i.p)),
    "band_occupancy_sequence": _dense(
        lambda i: A.band_occupancy_sequence(i.dwells, BAND_STEP_S, BANDS_PER_DAY, i.p)),
    "band_headcount": _dense(lambda i: H.band_headcount(i.dwells, i.fx.time_series_table(), i.p)),
    "band_headcount_by_commuter": _dense(
        lambda i: H.band_headcount(i.joined, i.fx.time_series_table(), i.p, by=["commuters"])),
    "dwell_minutes": _dense(lambda i: A.dwell_minutes(A.band_occupancy(i.dwells, i.fx.time_series_table(), i.p))),
    "attachment_joined": _dense(lambda i: i.joined),
    "attachment_final": _dense(
        lambda i: A.attachment_final(A.band_occupancy(i.joined, i.fx.time_series_table(), i.p))),
    # sinks
    "stamp_partition": _dense(lambda i: sinks.stamp_partition(i.users, RUN_DATE, LOAD_TS)),
    "partition_overwrite": _dense(_partition_overwrite),
    "load_summary": _dense(lambda i: sinks.load_summary(_partition_overwrite(i))),
}


# ---------------------------------------------------------------------------
# DuckDB oracles (literal forms)
# ---------------------------------------------------------------------------

# The dwell rules in literal SQL, from a relation ``site_events(user_id, date_dt,
# start_dt, ...)`` to ``micro``, ``links``, ``islands``, ``macro``, ``dwells``
# (contained) and ``dwells_ref`` (date-only resolution).
DWELL_CTES = """micro_pairs AS (
  SELECT a.date_dt, a.user_id, a.start_dt AS time_1, b.start_dt AS time_2
  FROM site_events a JOIN site_events b ON a.user_id = b.user_id AND a.date_dt = b.date_dt
  WHERE b.start_dt >= a.start_dt - INTERVAL 2700 SECOND
    AND b.start_dt <= a.start_dt - INTERVAL 60 SECOND
),
micro_first AS (
  SELECT date_dt, user_id, time_1, min(time_2) AS first_event
  FROM micro_pairs GROUP BY date_dt, user_id, time_1
),
micro AS (
  SELECT date_dt, user_id, first_event, max(time_1) AS last_event
  FROM micro_first GROUP BY date_dt, user_id, first_event
),
micro_seq AS (
  SELECT date_dt, user_id, first_event, last_event,
         CAST(row_number() OVER (PARTITION BY date_dt, user_id ORDER BY first_event) AS INTEGER) AS counter
  FROM micro
),
links AS (
  SELECT a.date_dt, a.user_id, a.first_event, a.last_event, a.counter,
         b.first_event AS first_event_2, b.last_event AS last_event_2, b.counter AS counter_2
  FROM micro_seq a JOIN micro_seq b ON a.user_id = b.user_id AND a.date_dt = b.date_dt
  WHERE b.counter - 1 = a.counter AND a.last_event >= b.first_event
),
islands AS (
  SELECT *, CAST(new_row - counter AS INTEGER) AS dwell_number FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY date_dt, user_id ORDER BY first_event) AS INTEGER) AS new_row
    FROM links)
),
macro AS (
  SELECT date_dt, user_id, dwell_number, max(last_event_2) AS last_event, min(first_event) AS first_event
  FROM islands GROUP BY date_dt, user_id, dwell_number
),
dwells AS (
  SELECT DISTINCT mi.date_dt, mi.user_id,
         coalesce(ma.first_event, mi.first_event) AS first_event,
         coalesce(ma.last_event, mi.last_event) AS last_event
  FROM micro mi LEFT JOIN macro ma
    ON mi.user_id = ma.user_id AND mi.date_dt = ma.date_dt
   AND mi.first_event >= ma.first_event AND mi.last_event <= ma.last_event
),
dwells_ref AS (
  SELECT DISTINCT mi.date_dt, mi.user_id,
         coalesce(ma.first_event, mi.first_event) AS first_event,
         coalesce(ma.last_event, mi.last_event) AS last_event
  FROM micro mi LEFT JOIN macro ma
    ON mi.date_dt = ma.date_dt AND mi.first_event <= ma.first_event AND mi.last_event <= ma.last_event
)"""


def _chain(mapping: str) -> str:
    excluded = MAPPINGS[mapping].excluded_area
    return sql_views(mapping) + f""",
trace AS (
  SELECT imsi AS user_id,
         CAST(coalesce(start_timestamp, end_timestamp) AS DATE) AS date_dt,
         coalesce(start_timestamp, end_timestamp) AS start_dt,
         coalesce(start_source_cell_id, end_source_cell_id) AS cell_id,
         year, month, day
  FROM raw_trace
),
trace_2 AS ({_EDITED_TRACE}),
site AS (SELECT DISTINCT source_cell_id AS cell_id FROM site_cell_table),
site_events AS (
  SELECT t.user_id, t.date_dt, t.start_dt, t.cell_id, t.year, t.month, t.day
  FROM trace t JOIN site s ON t.cell_id = s.cell_id
),
{DWELL_CTES},
dwells_table AS (
  SELECT date_dt, user_id, first_event, last_event,
         TIMESTAMP '{LOAD_TS}' AS load_timestamp,
         strftime(date_dt, '%Y') AS year, strftime(date_dt, '%m') AS month, strftime(date_dt, '%d') AS day
  FROM dwells
),
window_trailing AS (
  SELECT * FROM dwells_table
  WHERE make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), CAST(day AS INTEGER))
        BETWEEN DATE '{RUN_DATE}' - INTERVAL 30 DAY AND DATE '{RUN_DATE}'
),
window_componentwise AS (
  SELECT * FROM dwells_table
  WHERE year BETWEEN '2024' AND '2024' AND month BETWEEN '01' AND '01' AND day BETWEEN '01' AND '31'
),
user_day_visits AS (
  SELECT date_dt, user_id, count(*) AS visits FROM dwells GROUP BY date_dt, user_id
),
users AS (
  SELECT user_id, CAST(sum(visits) AS BIGINT) AS total_visits, count(DISTINCT date_dt) AS total_days,
         CASE WHEN sum(visits) > 6 THEN 1 ELSE 0 END AS commuters
  FROM (SELECT date_dt, user_id, count(*) AS visits FROM window_trailing GROUP BY date_dt, user_id) v
  GROUP BY user_id
),
users_componentwise AS (
  SELECT user_id, CAST(sum(visits) AS BIGINT) AS total_visits, count(DISTINCT date_dt) AS total_days,
         CASE WHEN sum(visits) > 6 THEN 1 ELSE 0 END AS commuters
  FROM (SELECT date_dt, user_id, count(*) AS visits FROM window_componentwise GROUP BY date_dt, user_id) v
  GROUP BY user_id
),
prev AS (
  SELECT e.date_dt, e.user_id, e.start_dt, e.cell_id, d.first_event, d.last_event
  FROM trace e JOIN dwells d ON e.user_id = d.user_id AND e.date_dt = d.date_dt
  WHERE e.start_dt < d.first_event AND e.start_dt > d.first_event - INTERVAL 2 HOUR
),
areas_ex AS (SELECT DISTINCT source_cell_id AS cell_id, msoa FROM area_cell_table WHERE msoa <> '{excluded}'),
areas AS (SELECT DISTINCT source_cell_id AS cell_id, msoa FROM area_cell_table),
cand AS (
  SELECT p.date_dt, p.user_id, p.first_event, p.last_event, p.cell_id, count(*) AS number_events
  FROM prev p JOIN areas_ex a ON p.cell_id = a.cell_id
  WHERE p.start_dt < p.first_event - INTERVAL 15 MINUTE
  GROUP BY p.date_dt, p.user_id, p.first_event, p.last_event, p.cell_id
),
top AS (
  SELECT date_dt, user_id, first_event, last_event, cell_id FROM (
    SELECT *, row_number() OVER (PARTITION BY date_dt, user_id, first_event
                                 ORDER BY number_events DESC, cell_id, last_event) AS max_events
    FROM cand) r
  WHERE max_events = 1
),
origin_step1 AS (
  SELECT d.date_dt, d.user_id, d.first_event, d.last_event, t.cell_id
  FROM dwells d LEFT JOIN top t
    ON d.user_id = t.user_id AND d.date_dt = t.date_dt AND d.first_event = t.first_event
),
rail AS (SELECT DISTINCT cell_id FROM rail_cell_table),
rail_events AS (
  SELECT p.cell_id, p.date_dt, p.start_dt, p.user_id FROM prev p JOIN rail r ON p.cell_id = r.cell_id
),
rail_trips AS (
  SELECT DISTINCT re.date_dt, re.user_id, d.first_event, d.last_event, 1 AS rail_trips
  FROM rail_events re JOIN dwells d ON re.user_id = d.user_id AND re.date_dt = d.date_dt
  WHERE re.start_dt < d.first_event AND re.start_dt > d.first_event - INTERVAL 60 MINUTE
),
other_trips AS (
  SELECT DISTINCT date_dt, user_id, first_event, last_event, 1 AS other_mode
  FROM prev WHERE start_dt < first_event AND start_dt > first_event - INTERVAL 15 MINUTE
),
joined AS (
  SELECT a2.*, o.other_mode FROM (
    SELECT a1.*, r.rail_trips FROM (
      SELECT d.date_dt, d.user_id, d.first_event, d.last_event, u.commuters, u.total_visits
      FROM dwells d LEFT JOIN users u ON d.user_id = u.user_id) a1
    LEFT JOIN rail_trips r ON a1.user_id = r.user_id AND a1.date_dt = r.date_dt
      AND a1.first_event = r.first_event AND a1.last_event = r.last_event) a2
  LEFT JOIN other_trips o ON a2.user_id = o.user_id AND a2.date_dt = o.date_dt
    AND a2.first_event = o.first_event AND a2.last_event = o.last_event
),
bands AS (
  SELECT d.date_dt, TRY_CAST(CAST(d.date_dt AS VARCHAR) || ' ' || s.ts AS TIMESTAMP) AS ts
  FROM (SELECT DISTINCT date_dt FROM trace) d CROSS JOIN time_series_table s
),
occupancy AS (
  SELECT d.date_dt, d.user_id, d.first_event, d.last_event, b.ts
  FROM dwells d JOIN bands b
    ON b.date_dt = d.date_dt AND b.ts > d.first_event AND d.last_event > b.ts - INTERVAL 14 MINUTE
),
attachment_occupancy AS (
  SELECT j.*, b.ts
  FROM joined j JOIN bands b
    ON b.date_dt = j.date_dt AND b.ts > j.first_event AND j.last_event > b.ts - INTERVAL 14 MINUTE
),
overwritten AS (
  SELECT date_dt, user_id, first_event, last_event,
         CASE WHEN date_dt = DATE '{RUN_DAY}' THEN TIMESTAMP '{RELOAD_TS}' ELSE load_timestamp END
           AS load_timestamp,
         year, month, day
  FROM dwells_table
)"""


# The edited trace in SQL, and the arrival automaton read event by event.
_TRACE = "user_id, date_dt, start_dt, cell_id, year, month, day"
_EDITED_TRACE = f"""SELECT user_id, date_dt, start_dt, CASE WHEN {MOVED} THEN cell_id + 1 ELSE cell_id END AS cell_id, year, month, day
  FROM trace WHERE NOT coalesce({GONE}, false)
  UNION ALL SELECT {_TRACE} FROM trace WHERE {DOUBLED}"""

_ARRIVAL_RUN = """WITH RECURSIVE once AS (
  SELECT user_id, start_dt, max(CASE WHEN cell_id IN (SELECT cell_id FROM site) THEN 2
                                     WHEN cell_id IN (SELECT cell_id FROM rail) THEN 1 ELSE 0 END) AS symbol
  FROM trace WHERE user_id IS NOT NULL AND start_dt IS NOT NULL GROUP BY user_id, start_dt
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_dt) AS k FROM once
),
run AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS TIMESTAMP) AS start_dt, 0 AS state, 0 AS came_from FROM once
  UNION ALL
  SELECT r.user_id, n.k, n.start_dt,
         CASE WHEN n.symbol = 2 THEN 3 WHEN n.symbol = 1 THEN 1 WHEN r.state = 1 THEN 2 ELSE 0 END, r.state
  FROM run r JOIN numbered n ON n.user_id = r.user_id AND n.k = r.k + 1
)"""


_MINUTES = "CAST(date_diff('second', first_event, ts) AS DOUBLE) / 60"

_FINAL: dict[str, tuple[str, str]] = {
    "scan_day": ("dense", "SELECT * FROM raw_trace WHERE year = '2024' AND month = '01' AND day = '15'"),
    "trace_normalised": ("dense", "SELECT * FROM trace"),
    "site_cells": ("dense", "SELECT * FROM site"),
    "area_cells": ("dense", "SELECT * FROM areas"),
    "area_cells_excluding_site": ("dense", "SELECT * FROM areas_ex"),
    "rail_cells": ("dense", "SELECT * FROM rail"),
    "time_bands": ("dense", "SELECT date_dt, ts FROM bands"),
    "site_events": ("dense", "SELECT * FROM site_events"),
    "micro_pairs": ("dense", "SELECT * FROM micro_pairs"),
    "micro_first_event": ("dense", "SELECT DISTINCT * FROM micro_first"),
    "micro_dwells": ("dense", "SELECT * FROM micro"),
    "micro_sequence": ("dense", "SELECT * FROM micro_seq"),
    "macro_links": ("dense", "SELECT * FROM links"),
    "macro_islands": ("dense", "SELECT * FROM islands"),
    "macro_dwells": ("dense", "SELECT date_dt, user_id, first_event, last_event FROM macro"),
    "dwells_contained": ("dense", "SELECT * FROM dwells"),
    "dwells_as_reference": ("dense", "SELECT * FROM dwells_ref"),
    "dominating_macros": ("dense", """SELECT mi.date_dt, mi.user_id, mi.first_event, mi.last_event, count(ma.first_event) AS n_macro,
       min(ma.first_event) AS nearest_first, arg_min(ma.last_event, (ma.first_event, ma.last_event)) AS nearest_last
       FROM micro mi LEFT JOIN (SELECT DISTINCT date_dt, first_event, last_event FROM macro) ma
       ON mi.date_dt = ma.date_dt AND ma.first_event >= mi.first_event AND ma.last_event >= mi.last_event
       GROUP BY mi.date_dt, mi.user_id, mi.first_event, mi.last_event"""),
    "dwells_islands": ("dense", "SELECT * FROM dwells"),
    "dwells_of_day": ("dense", "SELECT * FROM dwells_table WHERE year = '2024' AND month = '01' AND day = '15'"),
    "window_trailing": ("dense", "SELECT * FROM window_trailing"),
    "window_componentwise": ("dense", "SELECT * FROM window_componentwise"),
    "user_day_visits": ("sparse", "SELECT * FROM user_day_visits"),
    "user_frequency": ("sparse", "SELECT * FROM users"),
    "user_frequency_componentwise": ("sparse", "SELECT * FROM users_componentwise"),
    "frequency_incremental": ("sparse", f"""SELECT r.run_date, w.user_id, count(*) AS total_visits,
       count(DISTINCT w.date_dt) AS total_days, CASE WHEN count(*) > 6 THEN 1 ELSE 0 END AS commuters
       FROM (SELECT CAST(DATE '{STATE_DAYS[0]}' + i * INTERVAL 1 DAY AS DATE) AS run_date FROM range({len(STATE_DAYS)}) t(i)) r
       JOIN dwells_table w ON w.date_dt BETWEEN r.run_date - INTERVAL 30 DAY AND r.run_date
       GROUP BY r.run_date, w.user_id"""),
    "visitors_returning": ("sparse", f"""SELECT msoa, count(DISTINCT user_id) FILTER (was) AS visitors_first,
       count(DISTINCT user_id) FILTER (still) AS visitors_second,
       count(DISTINCT user_id) FILTER (was AND still) AS returning, count(DISTINCT user_id) AS visitors
       FROM (SELECT a.msoa, t.user_id, bool_or(t.date_dt <= DATE '{PERIODS[0][1]}') AS was,
                    bool_or(t.date_dt >= DATE '{PERIODS[1][0]}') AS still
             FROM trace t JOIN areas a ON t.cell_id = a.cell_id
             WHERE t.date_dt BETWEEN DATE '{PERIODS[0][0]}' AND DATE '{PERIODS[1][1]}' GROUP BY a.msoa, t.user_id) u
       GROUP BY msoa"""),
    "changed_user_days": ("dense", f"""SELECT k.date_dt, k.user_id, coalesce(b.n, 0) AS n_before, coalesce(a.n, 0) AS n_after
       FROM (SELECT DISTINCT date_dt, user_id FROM ((SELECT * FROM trace_2 EXCEPT ALL SELECT {_TRACE} FROM trace)
             UNION ALL (SELECT {_TRACE} FROM trace EXCEPT ALL SELECT * FROM trace_2)) d) k
       LEFT JOIN (SELECT date_dt, user_id, count(*) AS n FROM trace GROUP BY ALL) b
         ON k.date_dt IS NOT DISTINCT FROM b.date_dt AND k.user_id IS NOT DISTINCT FROM b.user_id
       LEFT JOIN (SELECT date_dt, user_id, count(*) AS n FROM trace_2 GROUP BY ALL) a
         ON k.date_dt IS NOT DISTINCT FROM a.date_dt AND k.user_id IS NOT DISTINCT FROM a.user_id"""),
    "dwells_refreshed": ("dense", f"""SELECT * FROM (WITH
       site_events AS (SELECT t.* FROM trace_2 t JOIN site s ON t.cell_id = s.cell_id),
       {DWELL_CTES}
       SELECT * FROM dwells) refreshed"""),
    "previous_events": ("dense", "SELECT * FROM prev"),
    "last_event_before": ("dense", """SELECT d.date_dt, d.user_id, d.first_event, d.last_event,
       e.start_dt AS last_known_event, e.cell_id AS last_known_cell
       FROM dwells d ASOF LEFT JOIN (
         SELECT user_id, start_dt, max(cell_id) AS cell_id FROM trace GROUP BY user_id, start_dt) e
       ON d.user_id = e.user_id AND d.first_event > e.start_dt"""),
    "origin_candidates": ("dense", "SELECT * FROM cand"),
    "origin_top_cell": ("dense", "SELECT * FROM top"),
    "origin_msoa": ("dense", """SELECT o.date_dt, o.user_id, o.first_event, o.last_event AS last_known_event,
       a.msoa AS origin_msoa FROM origin_step1 o JOIN areas a ON o.cell_id = a.cell_id"""),
    "origin_msoa_keep_unknown": ("dense", """SELECT o.date_dt, o.user_id, o.first_event,
       o.last_event AS last_known_event, a.msoa AS origin_msoa
       FROM origin_step1 o LEFT JOIN areas a ON o.cell_id = a.cell_id"""),
    "rail_events": ("dense", "SELECT * FROM rail_events"),
    "arrival_paths": ("dense", f"""SELECT * FROM ({_ARRIVAL_RUN}
       SELECT CAST(start_dt AS DATE) AS date_dt, user_id, count(*) FILTER (state = 3 AND came_from = 1) AS from_rail,
              count(*) FILTER (state = 3 AND came_from = 2) AS past_rail,
              count(*) FILTER (state = 3 AND came_from = 0) AS from_elsewhere
       FROM run WHERE k > 0 GROUP BY ALL) paths"""),
    "rail_trips": ("dense", "SELECT * FROM rail_trips"),
    "other_trips": ("dense", "SELECT * FROM other_trips"),
    "band_occupancy": ("dense", "SELECT * FROM occupancy"),
    "band_occupancy_sequence": ("dense", "SELECT * FROM occupancy"),
    "band_headcount": ("dense", "SELECT date_dt, ts, count(*) AS headcount FROM occupancy GROUP BY date_dt, ts"),
    "band_headcount_by_commuter": ("dense", """SELECT date_dt, commuters, ts, count(*) AS headcount
       FROM attachment_occupancy GROUP BY date_dt, commuters, ts"""),
    "dwell_minutes": ("dense", f"SELECT *, {_MINUTES} AS dwell_time FROM occupancy"),
    "attachment_joined": ("dense", "SELECT * FROM joined"),
    "attachment_final": ("dense", f"""SELECT date_dt, ts AS timeband, user_id, total_visits, commuters,
       first_event, last_event, {_MINUTES} AS dwell_time, rail_trips,
       CASE WHEN rail_trips = 1 THEN 0 WHEN other_mode IS NULL THEN 0 ELSE 1 END AS other_trips,
       CASE WHEN rail_trips IS NULL AND other_mode IS NULL THEN 1 ELSE 0 END AS tube_trips
       FROM attachment_occupancy"""),
    "stamp_partition": ("dense", f"""SELECT *, TIMESTAMP '{LOAD_TS}' AS load_timestamp,
       '2024' AS year, '01' AS month, '31' AS day FROM users"""),
    "partition_overwrite": ("dense", "SELECT * FROM overwritten"),
    "load_summary": ("dense", """SELECT year, month, day, count(*) AS record_count,
       max(load_timestamp) AS load_timestamp FROM overwritten GROUP BY year, month, day"""),
}


def oracle(name: str, mapping: str | None = None) -> str:
    """Oracle SQL of a query; ``mapping`` overrides the fixture mapping (tests)."""
    default, final = _FINAL[name]
    return f"WITH {_chain(mapping or default)}\n{final}"


ORACLES: dict[str, str] = {name: oracle(name) for name in _FINAL}
