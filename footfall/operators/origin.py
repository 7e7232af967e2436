"""Previous events and the area each visitor came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_us, minus_s
from ..params import DEFAULT, Params
from ..sources.dimensions import area_cells, area_cells_excluding
from .intervals import bucketed_range_join

US = 1_000_000
KEYS = ["user_id", "date_dt"]
PREVIOUS_COLUMNS = ["date_dt", "user_id", "start_dt", "cell_id", "first_event", "last_event"]


def previous_events(trace: DataFrame, dwells: DataFrame, p: Params = DEFAULT,
                    prefilter: bool = True) -> DataFrame:
    """Trace events of the user and date in ``(first_event - lookback, first_event)``.

    Interval join on ``(user_id, date_dt, time bucket)``: a dwell is copied to
    the (at most two) buckets its look-back touches, an event lives in one.

    The trace holds every user of the network, the dwells only the site's
    visitors.  With ``prefilter`` the trace is first cut to the visitors'
    ``(user_id, date_dt)`` by a semi join; Spark broadcasts that key set below
    its size threshold, or filters the scan by a bloom filter of it (``session``).
    """
    ev = trace.select("user_id", "date_dt", "start_dt", "cell_id")
    dw = dwells.select("user_id", "date_dt", "first_event", "last_event")
    if prefilter:
        visitors = dw.select("user_id", "date_dt").distinct()
        ev = ev.join(visitors, ["user_id", "date_dt"], "left_semi")
    # The start of the look-back is a column: interval arithmetic for every two rows that meet is slow.
    dw = dw.withColumn("_from", minus_s("first_event", p.lookback_s))
    cond = (F.col("p.start_dt") < F.col("r.first_event")) & (F.col("p.start_dt") > F.col("r._from"))
    j = bucketed_range_join(
        ev, dw, KEYS, point_us=epoch_us("start_dt"),
        lo_us=epoch_us("first_event") - F.lit(p.lookback_s * US), hi_us=epoch_us("first_event"),
        width_us=p.lookback_bucket_s * US, condition=cond)
    return j.select(F.col("p.date_dt").alias("date_dt"), F.col("p.user_id").alias("user_id"),
                    F.col("p.start_dt").alias("start_dt"), F.col("p.cell_id").alias("cell_id"),
                    F.col("r.first_event").alias("first_event"), F.col("r.last_event").alias("last_event"))


def origin_candidates(previous: DataFrame, area_cell_table: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Events more than ``origin_min_lead`` before the dwell, on cells outside the
    site's own area, counted per cell: ``number_events``.

    A cell listed under several areas is counted once per area (as the join
    multiplies rows), matching the original counts.
    """
    areas = area_cells_excluding(area_cell_table, p.excluded_area)
    return (
        previous.join(areas, "cell_id")
        .where(F.col("start_dt") < minus_s("first_event", p.origin_min_lead_s))
        .groupBy("date_dt", "user_id", "first_event", "last_event", "cell_id")
        .agg(F.count(F.lit(1)).alias("number_events"))
    )


def origin_top_cell(candidates: DataFrame) -> DataFrame:
    """The cell with most events per ``(date_dt, user_id, first_event)``.

    Ties go to the smaller ``cell_id`` (then earlier ``last_event``).  Written as
    a ``min_by`` aggregate, so it combines map-side like any aggregate instead of
    sorting whole groups.
    """
    order = F.struct(-F.col("number_events"), F.col("cell_id"), F.col("last_event"))
    best = F.min_by(F.struct("cell_id", "last_event"), order)
    return (
        candidates.groupBy("date_dt", "user_id", "first_event").agg(best.alias("_top"))
        .select("date_dt", "user_id", "first_event",
                F.col("_top.last_event").alias("last_event"), F.col("_top.cell_id").alias("cell_id"))
    )


def visitor_origin(dwells: DataFrame, top_cells: DataFrame, area_cell_table: DataFrame,
                   keep_unknown: bool = False) -> DataFrame:
    """``(date_dt, user_id, first_event, last_known_event, origin_msoa)``.

    Each dwell gets the area of its top origin cell (any area, the site's own
    included).  As in the original jobs a dwell without origin is dropped;
    ``keep_unknown=True`` keeps it with a null area.
    """
    areas = area_cells(area_cell_table)
    top = top_cells.select("user_id", "date_dt", "first_event", "cell_id")
    with_cell = dwells.select("date_dt", "user_id", "first_event", "last_event") \
        .join(top, ["user_id", "date_dt", "first_event"], "left")
    how = "left" if keep_unknown else "inner"
    return with_cell.join(areas, "cell_id", how).select(
        "date_dt", "user_id", "first_event",
        F.col("last_event").alias("last_known_event"), F.col("msoa").alias("origin_msoa"))


def origin(trace: DataFrame, dwells: DataFrame, area_cell_table: DataFrame, p: Params = DEFAULT,
           keep_unknown: bool = False) -> DataFrame:
    """Trace + dwells -> origin area of each dwell."""
    prev = previous_events(trace, dwells, p)
    top = origin_top_cell(origin_candidates(prev, area_cell_table, p))
    return visitor_origin(dwells, top, area_cell_table, keep_unknown)
