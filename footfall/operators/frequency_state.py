"""Visit frequency kept up to date day by day, from one day and the state of the day before.

``frequency.visit_frequency`` reads every day of the trailing window at each run.  Here a state table
holds, per user, the visits of each day of the window that has any (a sparse ring of at most
``trailing_days + 1`` entries) and their totals.  A run folds one day in, retracts the days that
leave the window, and writes the next version of the state, partition ``as_of=YYYY-MM-DD``.  Folding a day
replaces what the ring holds of it, so a rerun gives the same version, and a day whose dwells
changed later is folded again into the versions that hold it (``amend``).

Results are those of the trailing window over tables whose rows lie in the partition of their own
``date_dt``.  A null ``user_id`` is one user.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from ..plans.sinks import scratch_table_path
from ..sources.trace import scan_day, trailing_window

EPOCH = dt.date(1970, 1, 1)
RING = "array<struct<day:int,visits:bigint>>"


def _date(day: str | dt.date) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def _number(day: dt.date) -> int:
    return (day - EPOCH).days


def _visits_of(ring: Column) -> Column:
    return F.aggregate(ring, F.lit(0).cast("long"), lambda s, x: s + x.visits)


def state_of_window(dwells_table: DataFrame, as_of: str | dt.date, p: Params = DEFAULT) -> DataFrame:
    """The state as of a day, from all days of its window: ``user_id, ring, total_visits, total_days``."""
    day = F.datediff("date_dt", F.lit(EPOCH)).cast("int")
    days = (trailing_window(dwells_table, _date(as_of), p.trailing_days).groupBy("user_id", day.alias("day"))
            .agg(F.count(F.lit(1)).alias("visits")))
    return days.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("day", "visits"))).cast(RING).alias("ring"),
        F.sum("visits").alias("total_visits"), F.count(F.lit(1)).alias("total_days"))


def day_visits(dwells_table: DataFrame, day: str | dt.date) -> DataFrame:
    """``user_id, visits`` of one day; reads that day's partition only."""
    return scan_day(dwells_table, str(day)).groupBy("user_id").agg(F.count(F.lit(1)).alias("visits"))


def fold_day(state: DataFrame, visits: DataFrame, day: str | dt.date, as_of: str | dt.date,
             p: Params = DEFAULT) -> DataFrame:
    """The state as of ``as_of`` after the visits of ``day`` replaced what ``state`` (of that or an earlier
    day) holds of it.  A ``day`` outside the window changes nothing but the days that leave."""
    last, number = _number(_date(as_of)), _number(_date(day))
    first = last - p.trailing_days
    if not first <= number <= last:
        visits = visits.where("false")
    old = state.select("user_id", "ring", "total_visits", "total_days")
    new = visits.select(F.col("user_id").alias("_user"), F.col("visits").alias("_visits"))
    both = old.join(new, F.col("user_id").eqNullSafe(F.col("_user")), "full")
    ring = F.coalesce("ring", F.array().cast(RING))
    leaves = F.filter(ring, lambda x: (x.day < first) | (x.day > last) | (x.day == number))
    stays = F.filter(ring, lambda x: (x.day >= first) & (x.day <= last) & (x.day != number))
    entry = F.array(F.struct(F.lit(number).alias("day"), F.col("_visits").alias("visits"))).cast(RING)
    return both.select(
        F.coalesce("user_id", "_user").alias("user_id"),
        F.when(F.col("_visits").isNull(), stays).otherwise(F.sort_array(F.concat(stays, entry))).alias("ring"),
        (F.coalesce("total_visits", F.lit(0)) - _visits_of(leaves) + F.coalesce("_visits", F.lit(0))).alias("total_visits"),
        (F.coalesce("total_days", F.lit(0)) - F.size(leaves) + F.col("_visits").isNotNull().cast("int"))
        .cast("long").alias("total_days"),
    ).where("total_days > 0")


def frequency_of(state: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``user_id, total_visits, total_days, commuters``, as ``user_frequency`` gives them."""
    return state.select("user_id", "total_visits", "total_days", F.when(
        F.col("total_visits") > F.lit(p.commuter_over), 1).otherwise(0).alias("commuters"))


# ---------------------------------------------------------------- versions
def _folder(spark: SparkSession, path: str, as_of: dt.date):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/as_of={as_of}")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def read_version(spark: SparkSession, path: str, as_of: str | dt.date) -> DataFrame | None:
    """One version of the state; None if it was never written (or had no user)."""
    folder, system = _folder(spark, path, _date(as_of))
    return spark.read.parquet(folder.toString()) if system.exists(folder) else None


def write_version(state: DataFrame, path: str, as_of: str | dt.date) -> None:
    """Replace one version; others stay.  Without users the version's folder goes."""
    spark, seen = state.sparkSession, Observation()
    (state.select("user_id", "ring", "total_visits", "total_days", F.lit(str(_date(as_of))).alias("as_of"))
     .observe(seen, F.count(F.lit(1)).alias("users"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(path))
    if not seen.get["users"]:
        folder, system = _folder(spark, path, _date(as_of))
        system.delete(folder, True)


def advance(dwells_table: DataFrame, path: str, run_date: str | dt.date, p: Params = DEFAULT) -> DataFrame:
    """Write the version of ``run_date`` from that of the day before and the day's partition (from the
    whole window where there is none before), and return its frequencies."""
    spark, day = dwells_table.sparkSession, _date(run_date)
    before = read_version(spark, path, day - dt.timedelta(days=1))
    if before is None:
        state = state_of_window(dwells_table, day, p)
    else:
        state = fold_day(before, day_visits(dwells_table, day), day, day, p)
    write_version(state, path, day)
    return frequency_of(version_or_empty(dwells_table, path, day), p)


def amend(dwells_table: DataFrame, path: str, day: str | dt.date, as_of: str | dt.date, p: Params = DEFAULT) -> None:
    """Fold a day whose dwells changed after its run again into a written version."""
    spark = dwells_table.sparkSession
    scratch = scratch_table_path(spark, "frequency-state")  # a version is not read while it is replaced
    fold_day(version_or_empty(dwells_table, path, as_of), day_visits(dwells_table, day), day, as_of, p).write.parquet(scratch)
    write_version(spark.read.parquet(scratch), path, as_of)
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def version_or_empty(dwells_table: DataFrame, path: str, as_of: str | dt.date) -> DataFrame:
    """A version of the state, without rows if it had no user."""
    spark, user = dwells_table.sparkSession, dwells_table.schema["user_id"].dataType.simpleString()
    found = read_version(spark, path, as_of)
    if found is None:
        found = spark.createDataFrame([], f"user_id {user}, ring {RING}, total_visits bigint, total_days bigint")
    return found
