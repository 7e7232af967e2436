"""Time buckets with halos: the skew-splitting primitive of the library.

Every per-user-day computation of the jobs only looks a bounded time back or
ahead (45 min for dwell pairing, 2 h for previous events).  Instead of putting
a whole ``(user_id, date_dt)`` sequence into one task, rows are keyed by
``(user_id, date_dt, bucket)`` where ``bucket = epoch_us div width``.  A row is
also copied ("halo" copy, ``_own = false``) into the neighbouring buckets whose
rows may need it as context.  A busy user-day is thereby split into
``day / width`` independent groups; results are taken from own rows only.

Quantities that are not local in time (running counts, chain starts) are
stitched across buckets from a per-bucket summary, which holds at most
``day / width`` rows per user-day (see ``ordinal`` here and the chain pieces
in ``operators.dwell``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"
OWN = "_own"


def bucket_of(us: Column, width_us: int) -> Column:
    """Integer bucket of an epoch-microsecond column (exact integer division)."""
    return ((us - F.pmod(us, F.lit(width_us))) / F.lit(width_us)).cast("long")


def with_halo(df: DataFrame, us_col: str, width_us: int,
              back_us: int = 0, ahead_us: int = 0) -> DataFrame:
    """Assign ``_bucket`` and add halo copies.

    ``back_us``: rows of bucket ``b`` need rows up to ``back_us`` before them, so a
    row is copied forward into every bucket that starts within ``back_us`` after it.
    ``ahead_us``: symmetric, copies backwards.  ``_own`` marks the original row.
    A halo wider than a bucket reaches several neighbouring buckets.
    """
    us = F.col(us_col)
    own = bucket_of(us, width_us)
    lo = bucket_of(us - F.lit(ahead_us), width_us)
    hi = bucket_of(us + F.lit(back_us), width_us)
    return (
        df.withColumn("_own_bucket", own)
        .withColumn(BUCKET, F.explode(F.sequence(lo, hi)))
        .withColumn(OWN, F.col(BUCKET) == F.col("_own_bucket"))
        .drop("_own_bucket")
    )


def span_buckets(df: DataFrame, lo_us: Column, hi_us: Column, width_us: int) -> DataFrame:
    """One copy of each row per bucket that the closed range [lo_us, hi_us] touches."""
    return df.withColumn(
        BUCKET, F.explode(F.sequence(bucket_of(lo_us, width_us), bucket_of(hi_us, width_us)))
    )


def ordinal(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """``row_number()`` over ``keys`` in ``_us`` order, computed per bucket.

    Rows are numbered inside each ``(keys, _bucket)`` group and offset by the row
    count of all earlier buckets (a prefix sum over the per-bucket counts).
    Requires ``_us`` to be unique within ``keys`` for a deterministic result,
    like any row_number.
    """
    keys = list(keys)
    local = df.withColumn(
        "_local_rn", F.row_number().over(Window.partitionBy(*keys, BUCKET).orderBy("_us")))
    offsets = (
        local.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(
            Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)))
        .select(*keys, BUCKET, "_offset")
    )
    return (
        local.join(offsets, [*keys, BUCKET], "left")
        .withColumn(out, (F.col("_local_rn") + F.col("_offset")).cast("int"))
        .drop("_local_rn", "_offset")
    )
