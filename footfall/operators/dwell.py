"""Dwells: who stayed at the site, from when to when.

Rules (per user and event date):

* micro dwell: every site event ``t1`` is paired with the user's site events
  ``t2`` in ``[t1 - 45 min, t1 - 1 min]``; ``first_event(t1)`` is the earliest
  such ``t2``.  Events sharing one ``first_event`` form one micro dwell ending
  at their latest ``t1``.
* macro dwell: micro dwells ordered by ``first_event`` are chained while one
  ends at or after the next one starts; chains of two or more are macro dwells.
* dwell: each micro dwell replaced by the macro dwell that contains it
  (``contained``), or -- the original join, which ignores the user -- by every
  macro dwell of the date that starts and ends no earlier (``as_reference``).

Scalable forms used here instead of the literal self-joins:

* the pairing self-join + ``min`` is a range-frame ``min`` window; the same
  sorted pass (``event_stage``) also finds the event closing each micro dwell
  and whether the micro dwell starts a chain (the one emitted before it ends
  before it starts), so the ``counter + 1`` self-join is not needed;
* chains are merged from per-bucket pieces (``_chains``), with one small window
  per user-day to carry chain starts across buckets;
* every window runs on ``(user_id, date_dt, time bucket)`` with a halo, so one
  busy user-day is split over many tasks (see ``functions.buckets``).

The literal steps (pairs, numbered micro dwells, links, gaps-and-islands
numbers, containment and date-only joins) stay available as operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import BUCKET, OWN, bucket_of, ordinal, with_halo
from ..functions.timecols import epoch_us
from ..params import DEFAULT, Params
from ..sources.dimensions import site_cells
from .intervals import bucketed_range_join

US = 1_000_000
KEYS = ["user_id", "date_dt"]
DWELL_COLUMNS = ["date_dt", "user_id", "first_event", "last_event"]


# ---------------------------------------------------------------- site events
def events_at_site(trace: DataFrame, site_cell_table: DataFrame) -> DataFrame:
    """Trace rows whose cell belongs to the site (semi join, broadcast cells)."""
    cells = site_cells(site_cell_table)
    return trace.join(cells, "cell_id", "left_semi").select(*trace.columns)


def _clean(events: DataFrame) -> DataFrame:
    # Null user or time never meets a partner: inner equi-joins drop them.
    return events.where(F.col("user_id").isNotNull() & F.col("start_dt").isNotNull()) \
        .select("user_id", "date_dt", "start_dt")


# ---------------------------------------------------------------- micro dwells
def micro_pairs(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """All ``(time_1, time_2)`` pairs of one user-day with ``time_2`` 45..1 min before.

    The literal pairing step of the original job, kept as an operator; by
    definition its output grows with the square of a user's events per 45
    minutes, so no other operator uses it (dwells take the range-frame window
    of ``event_stage``).  Joined per time bucket, not per user-day; buckets are
    narrow, as rows of a bucket that are no pair cost as much as pairs, and a
    pair is tested on two longs, not by interval arithmetic.
    """
    ev = _clean(events).withColumn("_us", epoch_us("start_dt"))
    lo, hi = F.col("_us") - F.lit(p.micro_max_gap_s * US), F.col("_us") - F.lit(p.micro_min_gap_s * US)
    # points: candidate events t2; ranges: probe events t1 with their look-back range.
    j = bucketed_range_join(
        ev, ev.withColumns({"_lo": lo, "_hi": hi}), KEYS, point_us=F.col("_us"), lo_us=F.col("_lo"), hi_us=F.col("_hi"),
        width_us=p.pair_bucket_s * US, condition=F.col("p._us").between(F.col("r._lo"), F.col("r._hi")))
    return j.select(F.col("r.date_dt").alias("date_dt"), F.col("r.user_id").alias("user_id"),
                    F.col("r.start_dt").alias("time_1"), F.col("p.start_dt").alias("time_2"))


def event_stage(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The one window stage of the dwell job, on ``(user_id, date_dt, bucket)``.

    Per event (``start_dt``, epoch ``_us``):

    * ``first_event``: earliest event of the user-day in ``[t - 45 min, t - 1 min]``
      (range-frame ``min``; null when there is none);
    * ``_emit``: the event is the last one with its ``first_event``, i.e. it
      closes the micro dwell ``(first_event, start_dt)``.  ``first_event`` never
      decreases with ``t``, so this is "the next event has another one";
    * ``_start``: that micro dwell starts a chain: the micro dwell emitted
      before it ends before its ``first_event``.

    Halo: 2 x 45 min back (the look-back of the earliest event whose emission
    decides a chain start) and 45 min ahead (the next event, when it matters).
    Rows earlier than ``bucket start - 45 min`` have an incomplete look-back and
    only serve as context.  Duplicated events give duplicated rows; only the
    last of them emits.
    """
    gap, min_gap, width = p.micro_max_gap_s * US, p.micro_min_gap_s * US, p.bucket_s * US
    ev = _clean(events).withColumn("_us", epoch_us("start_dt"))
    x = with_halo(ev, "_us", width, back_us=2 * gap, ahead_us=gap)
    order = Window.partitionBy(*KEYS, BUCKET).orderBy("_us")
    complete = F.col("_us") >= F.col(BUCKET) * F.lit(width) - F.lit(gap)
    nxt = F.lead("first_event").over(order)
    emitted_before = F.last(F.when(F.col("_emit"), F.col("start_dt")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        x.withColumn("first_event", F.min("start_dt").over(order.rangeBetween(-gap, -min_gap)))
        .withColumn("_emit", complete & F.col("first_event").isNotNull()
                    & (nxt.isNull() | (nxt != F.col("first_event"))))
        .withColumn("_start", F.col("_emit") & (emitted_before.isNull()
                                                | (emitted_before < F.col("first_event"))))
    )


def micro_first_events(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``(date_dt, user_id, time_1, first_event)``: earliest partner of each event time.

    Only the range-frame ``min`` is needed here, so the halo is the 45 min
    look-back alone (``event_stage`` carries more for the chain flags).
    """
    gap, min_gap = p.micro_max_gap_s * US, p.micro_min_gap_s * US
    ev = _clean(events).withColumn("_us", epoch_us("start_dt"))
    x = with_halo(ev, "_us", p.bucket_s * US, back_us=gap)
    w = Window.partitionBy(*KEYS, BUCKET).orderBy("_us").rangeBetween(-gap, -min_gap)
    return (x.withColumn("first_event", F.min("start_dt").over(w))
            .where(F.col(OWN) & F.col("first_event").isNotNull())
            .select("date_dt", "user_id", F.col("start_dt").alias("time_1"), "first_event")
            .distinct())


def _emitted(events: DataFrame, p: Params) -> DataFrame:
    return (event_stage(events, p).where(F.col(OWN) & F.col("_emit"))
            .withColumnRenamed("start_dt", "last_event"))


def micro_dwells(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``(date_dt, user_id, first_event, last_event)``; ``first_event`` unique per user-day."""
    return _emitted(events, p).select(*DWELL_COLUMNS)


def _chains(m: DataFrame) -> DataFrame:
    """Merge micro dwells into chains: ``(date_dt, user_id, first_event, last_event, _n)``.

    ``m`` holds micro dwells with ``_start`` (starts a chain), ``_bucket`` and
    ``_us`` (order inside the bucket; starts and ends of micro dwells rise
    together, so either time orders them).  Inside each bucket a micro dwell
    gets the latest chain start so far (``_local``, running max); the ones
    before the bucket's first start (its "head") have none.  Aggregating by
    ``(bucket, _local)`` needs no shuffle (rows are hash-partitioned by bucket)
    and leaves one row per chain piece: chains are disjoint and at least
    ``micro_min_gap`` long, so a user-day has at most ~1440 of them plus one
    head per bucket.  A window over those pieces per user-day carries the
    latest start into each head; a last aggregation merges each chain.
    """
    inner = Window.partitionBy(*KEYS, BUCKET).orderBy("_us").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    pieces = (
        m.withColumn("_local", F.max(F.when(F.col("_start"), epoch_us("first_event"))).over(inner))
        .groupBy(*KEYS, BUCKET, "_local")
        .agg(F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"),
             F.count(F.lit(1)).alias("_n"))
    )
    carried = pieces.withColumn("_island", F.coalesce("_local", F.max("_local").over(
        Window.partitionBy(*KEYS).orderBy(BUCKET, F.col("_local").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return (carried.groupBy("date_dt", "user_id", "_island")
            .agg(F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"),
                 F.sum("_n").alias("_n")))


def dwells_from_events(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Dwells (``contained`` mode) straight from site events: one window stage
    (``event_stage``) finds micro dwells and chain starts, ``_chains`` merges."""
    return _chains(_emitted(events, p)).select(*DWELL_COLUMNS)


def macro_dwells_from_events(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Macro dwells (chains of at least two micro dwells) straight from site events."""
    return _chains(_emitted(events, p)).where(F.col("_n") >= 2).select(*DWELL_COLUMNS)


def micro_sequence(micro: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Micro dwells numbered per user-day in ``first_event`` order (``counter``, from 1)."""
    d = micro.withColumn("_us", epoch_us("first_event"))
    d = d.withColumn(BUCKET, bucket_of(F.col("_us"), p.bucket_s * US))
    return ordinal(d, KEYS, "counter").select(*DWELL_COLUMNS, "counter")


# ---------------------------------------------------------------- macro dwells
def macro_links(sequenced: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Pairs of consecutive micro dwells (``counter_2 = counter + 1``) that overlap.

    The successor that can overlap starts at most ``micro_max_gap`` after the
    current micro dwell (its span is bounded by the pairing rule), so ``lead``
    runs per time bucket with a forward halo.
    """
    d = sequenced.withColumn("_us", epoch_us("first_event"))
    x = with_halo(d, "_us", p.bucket_s * US, ahead_us=p.micro_max_gap_s * US)
    w = Window.partitionBy(*KEYS, BUCKET).orderBy("_us")
    return (
        x.withColumn("first_event_2", F.lead("first_event").over(w))
        .withColumn("last_event_2", F.lead("last_event").over(w))
        .withColumn("counter_2", F.lead("counter").over(w))
        .where(F.col(OWN) & (F.col("counter_2") - 1 == F.col("counter"))
               & (F.col("last_event") >= F.col("first_event_2")))
        .select(*DWELL_COLUMNS, "counter", "first_event_2", "last_event_2", "counter_2")
    )


def macro_islands(links: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Gaps and islands over links: ``dwell_number = new_row - counter``.

    Consecutive links have consecutive ``counter`` and ``new_row``; a gap in
    ``counter`` changes the difference, so each chain gets its own number.
    """
    d = links.withColumn("_us", epoch_us("first_event"))
    d = d.withColumn(BUCKET, bucket_of(F.col("_us"), p.bucket_s * US))
    return (ordinal(d, KEYS, "new_row")
            .withColumn("dwell_number", (F.col("new_row") - F.col("counter")).cast("int"))
            .drop("_us", BUCKET))


def macro_dwells_from_islands(islands: DataFrame) -> DataFrame:
    """One macro dwell per chain: first start, latest end of the linked successors."""
    return (islands.groupBy("date_dt", "user_id", "dwell_number")
            .agg(F.max("last_event_2").alias("last_event"), F.min("first_event").alias("first_event")))


def _flag_starts(micro: DataFrame, p: Params) -> DataFrame:
    """Micro dwells (any source) with ``_start``: no earlier micro dwell of the
    user-day ends at or after its start.  Only micro dwells starting at most
    ``micro_max_gap`` earlier can (their span is bounded by the pairing rule),
    so the test runs per bucket of ``first_event`` with a backward halo."""
    d = micro.select(*DWELL_COLUMNS).withColumn("_us", epoch_us("first_event"))
    x = with_halo(d, "_us", p.bucket_s * US, back_us=p.micro_max_gap_s * US)
    w = Window.partitionBy(*KEYS, BUCKET).orderBy("_us").rangeBetween(-p.micro_max_gap_s * US, -1)
    return (x.withColumn("_prev_last", F.max("last_event").over(w))
            .where(F.col(OWN))
            .withColumn("_start", F.col("_prev_last").isNull() | (F.col("_prev_last") < F.col("first_event"))))


def dwell_islands(micro: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Dwells in ``contained`` mode from micro dwells: each chain merged (gaps and islands)."""
    return _chains(_flag_starts(micro, p)).select(*DWELL_COLUMNS)


def macro_dwells(micro: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Macro dwells from micro dwells: chains of at least two."""
    return _chains(_flag_starts(micro, p)).where(F.col("_n") >= 2).select(*DWELL_COLUMNS)


# ---------------------------------------------------------------- resolution
def resolve_contained(micro: DataFrame, macro: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Each micro dwell replaced by the macro dwell of the same user containing it."""
    macro_r = macro.select(*DWELL_COLUMNS)
    cond = (F.col("p.first_event") >= F.col("r.first_event")) & (F.col("p.last_event") <= F.col("r.last_event"))
    j = bucketed_range_join(
        micro.select(*DWELL_COLUMNS), macro_r, KEYS,
        point_us=epoch_us("first_event"), lo_us=epoch_us("first_event"), hi_us=epoch_us("last_event"),
        width_us=p.bucket_s * US, condition=cond, how="left")
    return j.select(
        F.col("p.date_dt").alias("date_dt"), F.col("p.user_id").alias("user_id"),
        F.coalesce("r.first_event", "p.first_event").alias("first_event"),
        F.coalesce("r.last_event", "p.last_event").alias("last_event"),
    ).distinct()


def resolve_as_reference(micro: DataFrame, macro: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The original resolution: match on the date only (any user's macro dwell)
    that starts and ends no earlier than the micro dwell; coalesce; distinct.

    Output grows with micro x macro dwells per date.  The macro side is reduced
    to distinct ``(date_dt, first, last)`` and copied into every time bucket
    from the start of its date up to its own start bucket; a micro dwell joins
    in the bucket of its own start only.  So the date is not one task, every
    matching pair meets exactly once, and the left-outer join stays exact.
    """
    width = p.bucket_s * US
    day_start_us = epoch_us(F.col("date_dt").cast("timestamp_ntz"))
    ma = (macro.select("date_dt", "first_event", "last_event").distinct()
          .withColumn(BUCKET, F.explode(F.sequence(bucket_of(day_start_us, width),
                                                   bucket_of(epoch_us("first_event"), width))))
          .alias("ma"))
    mi = micro.select(*DWELL_COLUMNS).withColumn(BUCKET, bucket_of(epoch_us("first_event"), width)).alias("mi")
    cond = ((F.col("mi.date_dt") == F.col("ma.date_dt")) & (F.col(f"mi.{BUCKET}") == F.col(f"ma.{BUCKET}"))
            & (F.col("mi.first_event") <= F.col("ma.first_event"))
            & (F.col("mi.last_event") <= F.col("ma.last_event")))
    return mi.join(ma, cond, "left").select(
        F.col("mi.date_dt").alias("date_dt"), F.col("mi.user_id").alias("user_id"),
        F.coalesce("ma.first_event", "mi.first_event").alias("first_event"),
        F.coalesce("ma.last_event", "mi.last_event").alias("last_event"),
    ).distinct()


def resolve_dwells(micro: DataFrame, macro: DataFrame, mode: str = "contained",
                   p: Params = DEFAULT) -> DataFrame:
    if mode == "contained":
        return resolve_contained(micro, macro, p)
    if mode == "as_reference":
        return resolve_as_reference(micro, macro, p)
    raise ValueError(f"unknown dwell mode {mode!r}")


def dwells(site_events: DataFrame, mode: str = "contained", p: Params = DEFAULT) -> DataFrame:
    """Site events -> dwells ``(date_dt, user_id, first_event, last_event)``."""
    if mode == "contained":
        return dwells_from_events(site_events, p)
    return resolve_as_reference(micro_dwells(site_events, p), macro_dwells_from_events(site_events, p), p)
