"""Inputs of the jobs derived from the driver's ``events`` table.

The test data has no mobile trace, so the trace and the cell tables are
derived from ``events`` by fixed rules (FIXTURES.md).  Every rule exists twice,
once as DataFrame code and once as SQL text for the DuckDB oracles; both live
here so that they cannot drift apart.

Mappings:

* ``dense`` (default): 15 users (``user_id % 15``), 20 cells (``k % 20``) --
  many events per user-day, so dwell chains, rail and other trips occur.
* ``sparse``: raw user ids and 100 cells -- about two events per user-day,
  used for the visit-frequency / commuter flag.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.timecols import day_parts, plus_s, truncate_seconds


@dataclass(frozen=True)
class Mapping:
    name: str
    user_mod: int | None      # user_id % user_mod, or raw user ids
    cell_mod: int | None      # k % cell_mod, or raw k
    site_below: int           # site cells: cell_id < site_below
    rail_mod: int             # rail cells: cell_id % rail_mod ...
    rail_rem: int             # ... = rail_rem
    area_mod: int             # area of a cell: 'M' || (cell_id % area_mod)
    excluded_area: str        # the site's own area
    hot_every: int | None = None  # events with event_id % hot_every = 0 all go to user 0


# The two data mappings of FIXTURES.md.
DENSE = Mapping("dense", user_mod=15, cell_mod=20, site_below=12, rail_mod=10, rail_rem=9,
                area_mod=5, excluded_area="M0")
SPARSE = Mapping("sparse", user_mod=None, cell_mod=None, site_below=80, rail_mod=5, rail_rem=0,
                 area_mod=25, excluded_area="M7")
# Skew check (tests only): a third of all events belong to one user.
HOT = Mapping("hot", user_mod=None, cell_mod=20, site_below=12, rail_mod=10, rail_rem=9,
              area_mod=5, excluded_area="M0", hot_every=3)
MAPPINGS = {"dense": DENSE, "sparse": SPARSE, "hot": HOT}

# Null patterns that exercise coalesce, and the decoy offsets of
# the fallback columns (a decoy must never be picked).
START_TS_NULL_EVERY = 7        # start_timestamp null when event_id % 7 = 0
START_CELL_NULL_EVERY = 11     # start_source_cell_id null when event_id % 11 = 0
DECOY_SECONDS = 90             # end_timestamp = start + 90 s when start is present
DECOY_CELL_OFFSET = 1000       # end cell = cell + 1000 when the start cell is present

# Fixed value: ``props`` holds ``{"k": n}``; the pattern reads n (cheaper than a JSON parse).
K_PATTERN = r'"k"\s*:\s*(-?\d+)'

BANDS_PER_DAY = 96             # time bands every 15 minutes from 00:00
BAND_STEP_S = 15 * 60

RUN_DAY = "2024-01-15"         # the one-day scans
RUN_DATE = "2024-01-31"        # trailing 30 days cover the whole trace (2024-01-01..30)
LOAD_TS = "2024-01-31 06:00:00"  # load timestamp stamped on outputs


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# Derived trace tables already written in this session: key -> folder.
_WRITTEN: dict[tuple, str] = {}


def _events_identity(sf_dir: str) -> tuple:
    path = f"{sf_dir}/events.parquet"
    try:
        st = os.stat(path)
        return (path, st.st_size, st.st_mtime_ns)
    except OSError:            # not a local path: identify by name only
        return (path,)


class Fixture:
    """Driver tables -> trace and dimension tables of one mapping."""

    def __init__(self, spark: SparkSession, sf_dir: str, mapping: str = "dense"):
        self.spark = spark
        self.sf_dir = sf_dir
        self.m = MAPPINGS[mapping]

    # -- columns shared by the trace and the cell universe
    def _user(self) -> F.Column:
        user = F.col("user_id") % self.m.user_mod if self.m.user_mod else F.col("user_id")
        if self.m.hot_every:
            user = F.when(F.col("event_id") % self.m.hot_every == 0, F.lit(0).cast("long")).otherwise(user)
        return user

    def _cell(self) -> F.Column:
        k = F.regexp_extract("props", K_PATTERN, 1).cast("int")
        return k % self.m.cell_mod if self.m.cell_mod else k

    def raw_trace(self) -> DataFrame:
        """The trace as the jobs read it: a ``year/month/day`` partitioned Parquet
        table with the declared trace schema.

        It is derived from ``events`` once per session (and per version of the
        events file) and written under the session's checkpoint folder, so every
        query scans a real day-partitioned table (partition pruning, one split
        per day) rather than re-deriving the trace inside its own plan.
        """
        from ..plans.sinks import scratch_table_path   # plans depend on sources, not the reverse at import
        key = (self.spark.sparkContext.applicationId, self.m.name, _events_identity(self.sf_dir))
        path = _WRITTEN.get(key)
        if path is None:
            path = scratch_table_path(self.spark, f"trace-{self.m.name}")
            self.derived_trace().write.partitionBy("year", "month", "day").parquet(path)
            _WRITTEN[key] = path
        return self.spark.read.schema(schemas.TRACE).option("basePath", path).parquet(path)

    def derived_trace(self) -> DataFrame:
        """``imsi, start_timestamp, end_timestamp, start/end_source_cell_id, year, month, day``
        computed from ``events`` (the rules of the mapping)."""
        # Parse and truncate once; the CASE columns below only reference the results.
        ev = _events(self.spark, self.sf_dir).select(
            "event_id", self._user().alias("imsi"),
            truncate_seconds("ts").alias("_base"), self._cell().alias("_cell"))
        base, cell = F.col("_base"), F.col("_cell")
        no_start = F.col("event_id") % START_TS_NULL_EVERY == 0
        no_start_cell = F.col("event_id") % START_CELL_NULL_EVERY == 0
        parts = day_parts(F.to_date(base))
        return ev.select(
            "imsi",
            F.when(~no_start, base).alias("start_timestamp"),
            F.when(no_start, base).otherwise(plus_s(base, DECOY_SECONDS)).alias("end_timestamp"),
            F.when(~no_start_cell, cell).alias("start_source_cell_id"),
            F.when(no_start_cell, cell).otherwise(cell + DECOY_CELL_OFFSET).alias("end_source_cell_id"),
            parts["year"].alias("year"), parts["month"].alias("month"), parts["day"].alias("day"),
        )

    def _cells(self) -> DataFrame:
        """Every cell id seen in the trace (a small dimension, cached once it is built)."""
        return _events(self.spark, self.sf_dir).select(self._cell().alias("cell_id")).distinct().cache()

    def site_cell_table(self) -> DataFrame:
        """``source_cell_id`` of the monitored site."""
        return self._cells().where(F.col("cell_id") < self.m.site_below) \
            .select(F.col("cell_id").alias("source_cell_id"))

    def area_cell_table(self) -> DataFrame:
        """``source_cell_id, msoa``."""
        return self._cells().select(
            F.col("cell_id").alias("source_cell_id"),
            F.concat(F.lit("M"), (F.col("cell_id") % self.m.area_mod).cast("string")).alias("msoa"))

    def rail_cell_table(self) -> DataFrame:
        """``cell_id`` of rail stations."""
        return self._cells().where(F.col("cell_id") % self.m.rail_mod == self.m.rail_rem)

    def time_series_table(self) -> DataFrame:
        """``ts`` text ``HH:mm:ss``, one row per band of a day."""
        return self.spark.range(BANDS_PER_DAY).select(
            F.date_format(
                F.timestamp_seconds(F.col("id") * BAND_STEP_S).cast("timestamp_ntz"), "HH:mm:ss"
            ).alias("ts"))

    @property
    def excluded_area(self) -> str:
        return self.m.excluded_area


def sql_views(mapping: str = "dense") -> str:
    """``WITH`` clause defining ``raw_trace, site_cell_table, area_cell_table,
    rail_cell_table, time_series_table`` in DuckDB SQL (same rules as ``Fixture``)."""
    m = MAPPINGS[mapping]
    user = f"(user_id % {m.user_mod})" if m.user_mod else "user_id"
    if m.hot_every:
        user = f"CASE WHEN event_id % {m.hot_every} = 0 THEN CAST(0 AS BIGINT) ELSE {user} END"
    k = f"CAST(regexp_extract(props, '{K_PATTERN}', 1) AS INTEGER)"
    cell = f"({k} % {m.cell_mod})" if m.cell_mod else k
    return f"""
raw_trace AS (
  SELECT {user} AS imsi,
         CASE WHEN event_id % {START_TS_NULL_EVERY} <> 0 THEN date_trunc('second', ts) END AS start_timestamp,
         CASE WHEN event_id % {START_TS_NULL_EVERY} = 0 THEN date_trunc('second', ts)
              ELSE date_trunc('second', ts) + INTERVAL {DECOY_SECONDS} SECOND END AS end_timestamp,
         CASE WHEN event_id % {START_CELL_NULL_EVERY} <> 0 THEN {cell} END AS start_source_cell_id,
         CASE WHEN event_id % {START_CELL_NULL_EVERY} = 0 THEN {cell}
              ELSE {cell} + {DECOY_CELL_OFFSET} END AS end_source_cell_id,
         strftime(CAST(ts AS DATE), '%Y') AS year,
         strftime(CAST(ts AS DATE), '%m') AS month,
         strftime(CAST(ts AS DATE), '%d') AS day
  FROM events
),
cell_universe AS (SELECT DISTINCT {cell} AS cell_id FROM events),
site_cell_table AS (SELECT cell_id AS source_cell_id FROM cell_universe WHERE cell_id < {m.site_below}),
area_cell_table AS (SELECT cell_id AS source_cell_id, 'M' || CAST(cell_id % {m.area_mod} AS VARCHAR) AS msoa
                    FROM cell_universe),
rail_cell_table AS (SELECT cell_id FROM cell_universe WHERE cell_id % {m.rail_mod} = {m.rail_rem}),
time_series_table AS (
  SELECT strftime(TIMESTAMP '1970-01-01 00:00:00' + i * INTERVAL {BAND_STEP_S} SECOND, '%H:%M:%S') AS ts
  FROM range({BANDS_PER_DAY}) t(i)
)"""
