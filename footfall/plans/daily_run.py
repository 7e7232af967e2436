"""The daily run: dwells -> users -> origin and attachment, each written to its table.

Every step reads the previous step's *written* table (shared storage), as the
original jobs did, which also cuts the lineage between steps: a lost executor
recomputes at most the current step.  The previous events, input of both the
origin and the attachment step, are computed once per day and kept as a
scratch table in the checkpoint folder, so the day's trace is shuffled once
for them.  Each write replaces exactly the run
date's partition; its row count is observed during the write (no cache, no
second pass).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import attachment as A
from ..operators import dwell as D
from ..operators import frequency as Q
from ..operators import origin as O
from ..params import DEFAULT, Params
from ..sources.tables import Tables, read_output
from ..sources.trace import normalise_trace, scan_day
from . import sinks


@dataclass(frozen=True)
class Outputs:
    """Folder of each output table."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _write(df: DataFrame, outputs: Outputs, name: str, run_date, load_ts) -> int:
    cols = [f.name for f in schemas.OUTPUTS[name].fields if f.name not in ("load_timestamp", "year", "month",
                                                                          "day")]
    obs = Observation(f"{name}_rows")
    stamped = sinks.stamp_partition(df.select(*cols), run_date, load_ts).observe(obs, F.count(F.lit(1)).alias("n"))
    sinks.overwrite_partitions(stamped, outputs.path(name), cols)
    n = int(obs.get["n"])
    if n == 0:  # a dynamic overwrite without rows replaces nothing: empty the day
        sinks.drop_partition(df.sparkSession, outputs.path(name), run_date)
    return n


def _scratch(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the checkpoint folder and read it back (used twice)."""
    path = sinks.scratch_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def run_dwells(spark: SparkSession, tables: Tables, outputs: Outputs, run_date, load_ts,
               p: Params = DEFAULT, mode: str = "contained") -> int:
    trace = normalise_trace(scan_day(tables.read_trace(spark), run_date))
    site = D.events_at_site(trace, tables.read_site_cells(spark))
    if mode == "as_reference":
        # Micro dwells feed both the macro dwells and the date-only join: compute once.
        micro = _scratch(spark, D.micro_dwells(site, p), f"micro-dwells-{run_date}")
        out = D.resolve_as_reference(micro, D.macro_dwells(micro, p), p)
    else:
        out = D.dwells(site, mode, p)
    return _write(out, outputs, "dwells", run_date, load_ts)


def run_users(spark: SparkSession, outputs: Outputs, run_date, load_ts, p: Params = DEFAULT,
              window_mode: str = "trailing") -> int:
    dwells = read_output(spark, outputs.path("dwells"), "dwells")
    return _write(Q.visit_frequency(dwells, run_date, p, window_mode), outputs, "users", run_date, load_ts)


def _dwells_of_day(spark: SparkSession, outputs: Outputs, run_date) -> DataFrame:
    return scan_day(read_output(spark, outputs.path("dwells"), "dwells"), run_date)


def previous_events_of_day(spark: SparkSession, tables: Tables, outputs: Outputs, run_date,
                           p: Params = DEFAULT) -> DataFrame:
    """Trace events in the look-back of each dwell of the day (both the origin and
    the attachment step start from them)."""
    trace = normalise_trace(scan_day(tables.read_trace(spark), run_date))
    return O.previous_events(trace, _dwells_of_day(spark, outputs, run_date), p)


def write_previous_events(spark: SparkSession, tables: Tables, outputs: Outputs, run_date,
                          p: Params = DEFAULT) -> DataFrame:
    """Compute the previous events once and keep them as a scratch table in the
    session's checkpoint folder: the trace is shuffled once for both steps."""
    return _scratch(spark, previous_events_of_day(spark, tables, outputs, run_date, p),
                    f"previous-events-{run_date}")


def run_origin(spark: SparkSession, tables: Tables, outputs: Outputs, run_date, load_ts,
               p: Params = DEFAULT, keep_unknown: bool = False, previous: DataFrame | None = None) -> int:
    dwells = _dwells_of_day(spark, outputs, run_date)
    if previous is None:
        previous = previous_events_of_day(spark, tables, outputs, run_date, p)
    areas = tables.read_area_cells(spark)
    top = O.origin_top_cell(O.origin_candidates(previous, areas, p))
    out = O.visitor_origin(dwells, top, areas, keep_unknown)
    return _write(out, outputs, "origin_msoa", run_date, load_ts)


def run_attachment(spark: SparkSession, tables: Tables, outputs: Outputs, run_date, load_ts,
                   p: Params = DEFAULT, previous: DataFrame | None = None, zero_fill_rail: bool = False) -> int:
    dwells = _dwells_of_day(spark, outputs, run_date)
    users = scan_day(read_output(spark, outputs.path("users"), "users"), run_date)
    if previous is None:
        previous = previous_events_of_day(spark, tables, outputs, run_date, p)
    out = A.user_attachment(dwells, users, previous, tables.read_rail_cells(spark),
                            tables.read_time_series(spark), p, run_date=run_date, zero_fill_rail=zero_fill_rail)
    return _write(out, outputs, "users_attachment", run_date, load_ts)


def run_day(spark: SparkSession, tables: Tables, outputs: Outputs, run_date: str | dt.date,
            load_ts: str | dt.datetime | None = None, p: Params = DEFAULT, dwell_mode: str = "contained",
            window_mode: str = "trailing", keep_unknown_origin: bool = False,
            zero_fill_rail: bool = False) -> dict[str, int]:
    """All four jobs for one run date, in dependency order; rows written per table.

    The defaults are the corrected rules; ``dwell_mode="as_reference"`` and
    ``window_mode="componentwise"`` reproduce the original outputs.
    """
    load_ts = load_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    counts = {
        "dwells": run_dwells(spark, tables, outputs, run_date, load_ts, p, dwell_mode),
        "users": run_users(spark, outputs, run_date, load_ts, p, window_mode),
    }
    previous = write_previous_events(spark, tables, outputs, run_date, p)
    counts["origin_msoa"] = run_origin(spark, tables, outputs, run_date, load_ts, p, keep_unknown_origin,
                                       previous=previous)
    counts["users_attachment"] = run_attachment(spark, tables, outputs, run_date, load_ts, p, previous=previous,
                                                zero_fill_rail=zero_fill_rail)
    return counts
