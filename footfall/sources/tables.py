"""Readers for the job inputs stored as Parquet folders (production layout).

The trace is partitioned by ``year/month/day``; reading it with the declared
schema keeps those columns as text, so the day filter of ``scan_day`` prunes
partitions instead of scanning the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


@dataclass(frozen=True)
class Tables:
    """Folder of each input table."""

    trace: str
    site_cells: str
    area_cells: str
    rail_cells: str
    time_series: str

    def read_trace(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(schemas.TRACE).option("basePath", self.trace).parquet(self.trace)

    def read_site_cells(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(schemas.SITE_CELLS).parquet(self.site_cells)

    def read_area_cells(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(schemas.AREA_CELLS).parquet(self.area_cells)

    def read_rail_cells(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(schemas.RAIL_CELLS).parquet(self.rail_cells)

    def read_time_series(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(schemas.TIME_SERIES).parquet(self.time_series)


def read_output(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read one of the written tables (``dwells``, ``users``, ...) with its schema."""
    return spark.read.schema(schemas.OUTPUTS[name]).option("basePath", path).parquet(path)
