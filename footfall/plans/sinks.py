"""Output tables: load stamps, idempotent day-partition overwrite, load accounting."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import day_parts
from ..session import ensure_checkpoint_dir
from ..sources.trace import run_date_parts

PARTITION_COLUMNS = ["year", "month", "day"]

# Column order of each output table (positional contract of the original tables).
OUTPUT_COLUMNS = {
    "dwells": ["date_dt", "user_id", "first_event", "last_event"],
    "users": ["user_id", "total_visits", "total_days", "commuters"],
    "origin_msoa": ["date_dt", "user_id", "first_event", "last_known_event", "origin_msoa"],
    "users_attachment": ["date_dt", "timeband", "user_id", "total_visits", "commuters", "first_event",
                         "last_event", "dwell_time", "rail_trips", "other_trips", "tube_trips"],
}


def _load_ts(load_ts: str | dt.datetime) -> F.Column:
    return F.lit(str(load_ts)).cast("timestamp_ntz")


def stamp_partition(df: DataFrame, run_date: str | dt.date, load_ts: str | dt.datetime) -> DataFrame:
    """Append ``load_timestamp`` and the run date's ``year, month, day`` text."""
    y, m, d = run_date_parts(run_date)
    return df.withColumns({
        "load_timestamp": _load_ts(load_ts),
        "year": F.lit(y), "month": F.lit(m), "day": F.lit(d),
    })


def stamp_by_date(df: DataFrame, load_ts: str | dt.datetime, date_col: str = "date_dt") -> DataFrame:
    """Stamp for a multi-day load: each row goes to the partition of its own date."""
    parts = day_parts(date_col)
    return df.withColumns({"load_timestamp": _load_ts(load_ts), **parts})


def overwrite_partitions(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Replace exactly the ``year/month/day`` partitions present in ``df``.

    One dynamic-overwrite write: other days stay untouched and a failed write
    leaves the previous content of the day (no separate drop step).  Columns are
    written in the table's declared order.
    """
    cols = (columns or [c for c in df.columns if c not in PARTITION_COLUMNS and c != "load_timestamp"])
    ordered = df.select(*cols, "load_timestamp", *PARTITION_COLUMNS)
    (ordered.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITION_COLUMNS)
     .parquet(path))


def drop_partition(spark: SparkSession, path: str, run_date: str | dt.date) -> None:
    """Delete one day's folder of a table, if there is one (any Hadoop file system)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(
        "/".join([path.rstrip("/"), *(f"{c}={v}" for c, v in zip(PARTITION_COLUMNS, run_date_parts(run_date)))]))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a written table; partition columns stay text (no type inference)."""
    return spark.read.option("basePath", path).parquet(path)


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table under the session's checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tables/{name}-{uuid.uuid4().hex[:12]}"


def load_summary(table: DataFrame) -> DataFrame:
    """Rows and latest load time per written day: ``year, month, day, record_count, load_timestamp``."""
    return table.groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("record_count"), F.max("load_timestamp").alias("load_timestamp"))
