"""Paths as finite automata: a user's ordered events are read by a small automaton, split by time.

Reading a sequence is associative in the maps "state before -> state after": each time bucket is read
once for every state it may start in, buckets are composed to days, days to months and months to users, and
the state that each day starts in comes back down.  No group holds more than a bucket's seconds or the
periods of one level, however many events a user has, and events are shuffled once.

``ARRIVALS`` asks how people came to the site: straight from a rail cell, from a rail cell with one other
stop between, or otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import bucket_of
from ..functions.timecols import epoch_us, truncate_seconds
from ..params import DEFAULT, Params
from ..sources.dimensions import rail_cells, site_cells

US = 1_000_000


@dataclass(frozen=True)
class Automaton:
    """``moves[state][symbol]`` is the next state; reading starts in state 0.  ``marks`` names the moves
    ``(state, symbol)`` that are counted, each name a column of the result."""

    moves: tuple[tuple[int, ...], ...]
    marks: dict[str, frozenset[tuple[int, int]]]

    @property
    def symbols(self) -> int:
        return len(self.moves[0])

    def table(self, value: Callable[[int, int], int], kind: str) -> Column:
        """``value(state, symbol)`` of all moves, state by state, as a constant array."""
        return F.array(*(F.lit(value(s, x)).cast(kind) for s in range(len(self.moves)) for x in range(self.symbols)))


# Symbols of an event, the stronger one larger, and states of the arrivals automaton.
ELSEWHERE, RAIL, SITE = 0, 1, 2
AWAY, AT_RAIL, PAST_RAIL, AT_SITE = 0, 1, 2, 3
ARRIVALS = Automaton(
    moves=((AWAY, AT_RAIL, AT_SITE), (PAST_RAIL, AT_RAIL, AT_SITE), (AWAY, AT_RAIL, AT_SITE), (AWAY, AT_RAIL, AT_SITE)),
    marks={"from_rail": frozenset({(AT_RAIL, SITE)}), "past_rail": frozenset({(PAST_RAIL, SITE)}),
           "from_elsewhere": frozenset({(AWAY, SITE)})},
)


def arrival_symbols(trace: DataFrame, site_cell_table: DataFrame, rail_cell_table: DataFrame) -> DataFrame:
    """``user_id, start_dt, symbol``: a site cell, else a rail cell, else (also without a cell) elsewhere."""
    site = site_cells(site_cell_table).withColumn("_site", F.lit(True))
    rail = rail_cells(rail_cell_table).withColumn("_rail", F.lit(True))
    symbol = F.when(F.col("_site"), SITE).when(F.col("_rail"), RAIL).otherwise(ELSEWHERE)
    return (trace.select("user_id", "start_dt", "cell_id").join(site, "cell_id", "left").join(rail, "cell_id", "left")
            .select("user_id", "start_dt", symbol.alias("symbol")))


def _unread(a: Automaton) -> Column:
    """Nothing read yet: per state to start in, that state and no marks."""
    zeros = [F.lit(0).cast("long").alias(m) for m in a.marks]
    return F.array(*(F.struct(F.lit(s).alias("state"), *zeros) for s in range(len(a.moves))))


def _read_event(a: Automaton) -> Callable[[Column, Column], Column]:
    moves = a.table(lambda s, x: a.moves[s][x], "int")
    hits = {m: a.table(lambda s, x, on=on: int((s, x) in on), "long") for m, on in a.marks.items()}

    def step(runs: Column, event: Column) -> Column:
        def one(run: Column) -> Column:
            move = run["state"] * a.symbols + event["symbol"]
            return F.struct(F.get(moves, move).alias("state"), *((run[m] + F.get(h, move)).alias(m) for m, h in hits.items()))
        return F.transform(runs, one)
    return step


def _read_part(a: Automaton) -> Callable[[Column, Column], Column]:
    """Composition: what was read so far, then a part that was read from every state."""
    def step(runs: Column, part: Column) -> Column:
        def one(run: Column) -> Column:
            then = F.get(part["runs"], run["state"])
            return F.struct(then["state"].alias("state"), *((run[m] + then[m]).alias(m) for m in a.marks))
        return F.transform(runs, one)
    return step


def _with_starts(parts: Column, start: Column) -> Column:
    """Each part of an ordered array beside the state it starts in."""
    walk = F.aggregate(
        parts, F.struct(start.alias("state"), F.array().cast("array<int>").alias("starts")),
        lambda seen, part: F.struct(F.get(part["runs"], seen["state"])["state"].alias("state"),
                                    F.concat(seen["starts"], F.array(seen["state"])).alias("starts")))
    return F.arrays_zip(parts.alias("part"), walk["starts"].alias("start"))


def count_marks(events: DataFrame, automaton: Automaton, p: Params = DEFAULT) -> DataFrame:
    """``date_dt, user_id`` and a count per mark, for each day on which a user has events.

    ``events`` has ``user_id, start_dt, symbol``; times are cut to whole seconds and of several symbols in
    one second the largest is read.  The state goes on over days.  Rows without user, time or symbol are
    not read; other columns are ignored.
    """
    # One symbol per user and second, which also combines a busy user's rows before the shuffle.
    once = (events.where("user_id is not null and start_dt is not null and symbol is not null")
            .groupBy("user_id", truncate_seconds("start_dt").alias("at")).agg(F.max("symbol").alias("symbol")))
    day = F.to_date("at")
    buckets = (once.groupBy("user_id", day.alias("date_dt"), bucket_of(epoch_us("at"), p.bucket_s * US).alias("bucket"))
               .agg(F.sort_array(F.collect_list(F.struct("at", "symbol"))).alias("parts"))
               .withColumn("runs", F.aggregate("parts", _unread(automaton), _read_event(automaton))))

    def composed(df: DataFrame, keys: list[Column | str], order: str, *inner: str) -> DataFrame:
        return (df.groupBy("user_id", *keys)
                .agg(F.sort_array(F.collect_list(F.struct(order, "runs", *inner))).alias("parts"))
                .withColumn("runs", F.aggregate("parts", _unread(automaton), _read_part(automaton))))

    days = composed(buckets, ["date_dt"], "bucket").drop("parts")
    months = composed(days, [F.trunc("date_dt", "month").alias("month")], "date_dt")
    users = composed(months, [], "month", "parts")
    by_month = users.select("user_id", F.explode(_with_starts(F.col("parts"), F.lit(0))).alias("m"))
    by_day = by_month.select("user_id", F.explode(_with_starts(F.col("m.part.parts"), F.col("m.start"))).alias("d"))
    run = F.get(F.col("d.part.runs"), F.col("d.start"))
    return by_day.select(F.col("d.part.date_dt").alias("date_dt"), "user_id", *(run[m].alias(m) for m in automaton.marks))


def arrival_paths(trace: DataFrame, site_cell_table: DataFrame, rail_cell_table: DataFrame,
                  p: Params = DEFAULT) -> DataFrame:
    """``date_dt, user_id, from_rail, past_rail, from_elsewhere``: arrivals at the site per user and day."""
    return count_marks(arrival_symbols(trace, site_cell_table, rail_cell_table), ARRIVALS, p)
