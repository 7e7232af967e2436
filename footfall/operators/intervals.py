"""Bucketed interval joins.

A join with an equality on ``(user_id, date_dt)`` plus a time range puts all
pairs of one user-day into one task, which is quadratic for a busy user.
Here the equality is widened by a time bucket: the point side gets the bucket
of its time, the range side is copied into every bucket its range touches, and
the range predicate stays as the join condition.  Each matching pair meets in
exactly one bucket, so row multiplicities are those of the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import BUCKET, bucket_of, span_buckets


def bucketed_range_join(points: DataFrame, ranges: DataFrame, keys: Sequence[str],
                        point_us: Column, lo_us: Column, hi_us: Column, width_us: int,
                        condition: Column, how: str = "inner") -> DataFrame:
    """Join ``points`` (alias ``p``) with ``ranges`` (alias ``r``).

    ``point_us`` is evaluated on ``points``; ``lo_us``/``hi_us`` on ``ranges`` and
    must enclose every point the ``condition`` can accept.  ``condition`` refers
    to ``p.<col>`` and ``r.<col>``.  ``how`` may be ``inner`` or ``left`` (points
    are never copied, so left-outer semantics are exact).  Select the output
    with qualified names; the helper columns ``_bucket`` exist on both sides.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    p = points.withColumn(BUCKET, bucket_of(point_us, width_us)).alias("p")
    r = span_buckets(ranges, lo_us, hi_us, width_us).alias("r")
    cond = F.col(f"p.{BUCKET}") == F.col(f"r.{BUCKET}")
    for k in keys:
        cond = cond & (F.col(f"p.{k}") == F.col(f"r.{k}"))
    return p.join(r, cond & condition, how)
