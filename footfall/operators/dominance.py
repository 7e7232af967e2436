"""How many macro dwells of a date start and end no earlier than a micro dwell, and the nearest one.

``dwell.resolve_as_reference`` makes a row for each such pair.  Counting them is two-dimensional dominance:
starts of a day, in seconds, are the leaves of a binary tree; a macro dwell is a mark in each node above its
start, and the starts from a second on are at most one node per level.  In a node only the end is left to
compare: a running sum over ends, latest first.  Marks and questions of a node are combined per end before anything is
sorted, so a node has at most two rows per second of ends, however many dwells there are; all rows together
are at most ``LEVELS + 1`` per dwell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The seconds of a day are fewer than ``2 ** LEVELS``.
LEVELS = 17
MARK, QUESTION = 0, 1


def _second(at: str) -> Column:
    """Seconds of ``at`` since the midnight that starts ``date_dt``."""
    return F.unix_seconds(F.col(at).cast("timestamp")) - F.unix_seconds(F.col("date_dt").cast("timestamp"))


def dominating_macros(micro: DataFrame, macro: DataFrame) -> DataFrame:
    """``date_dt, user_id, first_event, last_event, n_macro, nearest_first, nearest_last`` per row of ``micro``.

    ``n_macro``: distinct ``(first_event, last_event)`` of ``macro`` on its date, any user's, with both no earlier;
    ``nearest_*``: the one of them that starts first (then ends first), null without any.  Times are
    whole seconds and ``first_event`` lies on ``date_dt``, as ``normalise_trace`` makes them.  Rows without a
    date or a time match nothing; repeated micro dwells stay repeated; other columns are not read.
    """
    at = {"a": _second("first_event"), "b": _second("last_event")}
    marks = (macro.select("date_dt", *[c.alias(n) for n, c in at.items()]).where("a is not null and b is not null").distinct()
             .withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
             .groupBy("date_dt", "level", F.expr("shiftright(a, level)").alias("node"), "b")
             .agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("start")))
    own = micro.select("date_dt", "user_id", "first_event", "last_event", *[c.alias(n) for n, c in at.items()])
    # The second itself, and on each level the right neighbour of a left child above it.
    to_the_right = F.expr(f"""filter(transform(sequence(0, {LEVELS - 1}), k -> struct(k as level, shiftright(a, k) + 1L as node)),
                          x -> x.node % 2 = 1)""")
    itself = F.array(F.struct(F.lit(0).alias("level"), F.col("a").alias("node")))
    asked = (own.where("a is not null and b is not null").select("date_dt", "a", "b").distinct()
             .select("*", F.inline(F.concat(itself, to_the_right))))
    questions = asked.select("date_dt", "level", "node", "b").distinct()
    no_number = F.lit(None).cast("long")
    rows = marks.withColumn("kind", F.lit(MARK)).unionByName(
        questions.select("*", no_number.alias("n"), no_number.alias("start"), F.lit(QUESTION).alias("kind")))
    from_latest = (Window.partitionBy("date_dt", "level", "node").orderBy(F.desc("b"), "kind")
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    mark = F.when(F.col("kind") == MARK, F.struct(F.col("start"), F.col("b").alias("end")))
    answers = (rows.select("date_dt", "level", "node", "b", "kind", F.sum("n").over(from_latest).alias("n"),
                           F.min(mark).over(from_latest).alias("nearest"))
               .where((F.col("kind") == QUESTION) & (F.col("n") > 0)).drop("kind"))
    found = (asked.join(answers, ["date_dt", "level", "node", "b"]).groupBy("date_dt", "a", "b")
             .agg(F.sum("n").alias("n_macro"), F.min("nearest").alias("nearest")))
    midnight = F.unix_seconds(F.col("date_dt").cast("timestamp"))

    def time(part: str) -> Column:
        return F.timestamp_seconds(midnight + F.col(f"nearest.{part}")).cast("timestamp_ntz")

    return own.join(found, ["date_dt", "a", "b"], "left").select(
        "date_dt", "user_id", "first_event", "last_event", F.coalesce("n_macro", F.lit(0).cast("long")).alias("n_macro"),
        time("start").alias("nearest_first"), time("end").alias("nearest_last"))
