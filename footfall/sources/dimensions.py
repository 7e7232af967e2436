"""Small reference tables: cells of the site, of areas, of rail lines; time bands.

Joins with them carry no hint: Spark's size threshold and adaptive execution choose the
join from the sizes in bytes that it measures.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def site_cells(cells: DataFrame) -> DataFrame:
    """Distinct cell ids of the monitored site (``source_cell_id`` -> ``cell_id``)."""
    return cells.select(F.col("source_cell_id").alias("cell_id")).distinct()


def area_cells(cells: DataFrame) -> DataFrame:
    """Distinct ``(cell_id, msoa)`` pairs of the area table."""
    return cells.select(F.col("source_cell_id").alias("cell_id"), "msoa").distinct()


def area_cells_excluding(cells: DataFrame, excluded_area: str) -> DataFrame:
    """Area pairs without one area (rows with a null area drop out as well)."""
    return area_cells(cells.where(F.col("msoa") != F.lit(excluded_area)))


def rail_cells(cells: DataFrame) -> DataFrame:
    """Distinct cell ids of the rail stations (column already named ``cell_id``)."""
    return cells.select("cell_id").distinct()


def band_timestamps(series: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Band text ``HH:mm:ss`` on ``run_date`` -> timestamp column ``ts``.

    Malformed text gives null (``try_cast``), and a null band stays null.
    """
    return series.select(
        F.concat(F.lit(str(run_date)), F.lit(" "), F.col("ts")).try_cast("timestamp_ntz").alias("ts"))


def band_hour(ts_text: str = "ts") -> Column:
    """Hour of day (0..23) of a band given as ``HH:mm:ss`` text."""
    return F.hour(F.concat(F.lit("1970-01-01 "), F.col(ts_text)).try_cast("timestamp_ntz"))


def band_grid(series: DataFrame, dates: DataFrame) -> DataFrame:
    """Bands for several run dates at once: ``(date_dt, ts)``.

    ``dates`` holds a ``date_dt`` column.  Each date is spread over its 24 hours
    and equi-joined with the bands of that hour, so the grid is built
    without a cartesian product; its size is bands-per-day times dates.
    """
    days = dates.select("date_dt").distinct().withColumn("_hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    bands = series.select("ts").withColumn("_hour", band_hour("ts"))
    return (
        days.join(bands, "_hour")
        .select("date_dt",
                F.concat(F.col("date_dt").cast("string"), F.lit(" "), F.col("ts"))
                .try_cast("timestamp_ntz").alias("ts"))
    )
