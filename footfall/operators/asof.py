"""As-of match: the last event before a moment, however long ago, split by time.

The 2 h look-back of ``origin.previous_events`` bounds how far a bucketed join must look.  Without a
bound the answer may lie many empty buckets back, so a state is carried: events and probes meet in
``(user, bucket)`` groups, where a running ``last`` finds the event within the bucket; what is left
takes the last event of all earlier buckets, a running ``last`` over one row per bucket that is not
empty.  A busy user is as many groups as the buckets they were seen in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import bucket_of
from ..functions.timecols import epoch_us
from ..params import DEFAULT, Params

US = 1_000_000
# Order at one time: a probe looks strictly before its time.
PROBE, EVENT = 0, 1


def last_event_before(trace: DataFrame, dwells: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``date_dt, user_id, first_event, last_event, last_known_event, last_known_cell``: per dwell the time
    and cell of the user's last event strictly before ``first_event``, on any date (null: there is none).

    Of events at one time the largest cell id is taken (null cells only where there is no other).
    Events without a time or a user match nothing, dwells without a user get nulls; repeated dwells
    stay repeated.
    """
    width = p.lookback_bucket_s * US
    # One event per user and time, which also combines repeated rows before the shuffle.
    events = (trace.where("user_id is not null and start_dt is not null").groupBy("user_id", "start_dt")
              .agg(F.max("cell_id").alias("cell_id")))
    event = F.struct(F.col("start_dt").alias("at"), F.col("cell_id").alias("cell"))
    empty = F.lit(None).cast(events.select(event.alias("e")).schema["e"].dataType)
    no_time = F.lit(None).cast("timestamp_ntz")
    no_date = F.lit(None).cast(dwells.schema["date_dt"].dataType)
    rows = events.select(
        "user_id", epoch_us("start_dt").alias("us"), F.lit(EVENT).alias("kind"), event.alias("event"),
        no_date.alias("date_dt"), no_time.alias("first_event"), no_time.alias("last_event"),
    ).unionByName(dwells.select(
        "user_id", epoch_us("first_event").alias("us"), F.lit(PROBE).alias("kind"), empty.alias("event"),
        "date_dt", "first_event", "last_event")).withColumn("bucket", bucket_of(F.col("us"), width))
    inside = Window.partitionBy("user_id", "bucket").orderBy("us", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    probes = rows.withColumn("found", F.last("event", ignorenulls=True).over(inside)).where(F.col("kind") == PROBE)
    # The last event of each bucket, carried over the buckets after it.
    earlier = Window.partitionBy("user_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (rows.groupBy("user_id", "bucket").agg(F.max("event").alias("newest"), F.min("kind").alias("kind"))
               .withColumn("carried", F.last("newest", ignorenulls=True).over(earlier))
               .where(F.col("kind") == PROBE)
               .select(F.col("user_id").alias("_user"), F.col("bucket").alias("_bucket"), "carried"))
    met = probes.join(carried, F.col("user_id").eqNullSafe(F.col("_user")) & F.col("bucket").eqNullSafe(F.col("_bucket")))
    known = F.when(F.col("user_id").isNotNull(), F.coalesce("found", "carried"))
    return met.withColumn("known", known).select(
        "date_dt", "user_id", "first_event", "last_event", F.col("known.at").alias("last_known_event"),
        F.col("known.cell").alias("last_known_cell"))
