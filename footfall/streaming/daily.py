"""Run the daily jobs as new trace days arrive (Structured Streaming trigger).

The original jobs are batch jobs started once per day by an external
scheduler.  Here a file-source stream over the partitioned trace folder plays
that role: each micro-batch holds the newly landed files; ``foreachBatch``
finds which ``year/month/day`` partitions they belong to (a handful of rows,
aggregated on the executors) and runs ``run_day`` for each of those days.  The
stream's checkpoint records which files were processed, so a restarted query
does not reload a day twice, and ``trigger(availableNow=True)`` gives the
scheduled "process what has arrived, then stop" behaviour.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..params import DEFAULT, Params
from ..plans.daily_run import Outputs, run_day
from ..sources.tables import Tables


def _days_in(batch: DataFrame) -> list[dt.date]:
    days = batch.select("year", "month", "day").distinct().collect()   # one row per day in the batch
    return sorted(dt.date(int(r["year"]), int(r["month"]), int(r["day"])) for r in days)


def start_daily_loads(spark: SparkSession, tables: Tables, outputs: Outputs, checkpoint: str,
                      p: Params = DEFAULT, available_now: bool = True) -> StreamingQuery:
    """Start the trigger; each new trace day is loaded once by ``run_day``."""
    stream = (spark.readStream.schema(schemas.TRACE).option("basePath", tables.trace)
              .parquet(tables.trace).select("year", "month", "day"))

    def load(batch: DataFrame, _batch_id: int) -> None:
        for day in _days_in(batch):
            run_day(batch.sparkSession, tables, outputs, day, p=p)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
