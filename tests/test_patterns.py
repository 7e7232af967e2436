"""Path automata against reading each user's events one after another."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest

from footfall.operators.patterns import ARRIVALS, Automaton, arrival_paths, count_marks
from footfall.params import Params

DAY = dt.datetime(2023, 12, 30)
SYMBOLS = "user_id bigint, start_dt timestamp_ntz, symbol int, date_dt string, runs int"


def events(seed, n=400, users=(1, 2, 3, None), days=40, symbols=3):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        at = DAY + dt.timedelta(days=rnd.randrange(days), seconds=rnd.choice([0, 7199, 7200, rnd.randrange(86400)]),
                                microseconds=rnd.choice([0, 1, 999999]))
        rows.append((rnd.choice(users), rnd.choice([at] * 20 + [None]), rnd.choice([*range(symbols)] * 5 + [None]), "clash", 1))
    return rows + rows[:20]


def sequential(rows, a: Automaton):
    """Marks per user and day, by reading second by second."""
    seen = {}
    for user, at, symbol, *_ in rows:
        if None not in (user, at, symbol):
            key = (user, at.replace(microsecond=0))
            seen[key] = max(seen.get(key, 0), symbol)
    state, counts, days = {}, Counter(), set()
    for (user, at), symbol in sorted(seen.items()):
        move = (state.get(user, 0), symbol)
        days.add((at.date(), user))
        for mark, on in a.marks.items():
            counts[at.date(), user, mark] += move in on
        state[user] = a.moves[move[0]][symbol]
    return sorted((*d, *(counts[(*d, m)] for m in a.marks)) for d in days)


def some_automaton(seed, states=5, symbols=4):
    rnd = random.Random(seed)
    moves = tuple(tuple(rnd.randrange(states) for _ in range(symbols)) for _ in range(states))
    every = [(s, x) for s in range(states) for x in range(symbols)]
    return Automaton(moves, {"m1": frozenset(rnd.sample(every, 6)), "m2": frozenset(rnd.sample(every, 3)), "none": frozenset()})


@pytest.mark.parametrize("bucket_s", [2700, 7200, 5000, 86400])
def test_arrivals_by_any_bucket(spark, bucket_s):
    rows = events(bucket_s)
    got = count_marks(spark.createDataFrame(rows, SYMBOLS).repartition(3), ARRIVALS, Params(bucket_s=bucket_s))
    assert sorted(map(tuple, got.collect())) == sequential(rows, ARRIVALS)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_automaton(spark, seed):
    a, rows = some_automaton(seed), events(seed, symbols=4)
    assert sorted(map(tuple, count_marks(spark.createDataFrame(rows, SYMBOLS), a).collect())) == sequential(rows, a)


def test_a_busy_user_and_nothing(spark):
    rows = events(9, n=3000, users=(1,), days=3)
    got = count_marks(spark.createDataFrame(rows, SYMBOLS), ARRIVALS)
    assert sorted(map(tuple, got.collect())) == sequential(rows, ARRIVALS)
    assert count_marks(spark.createDataFrame([], SYMBOLS), ARRIVALS).count() == 0


def test_state_goes_on_over_days_and_site_wins(spark):
    """A rail event in one month, the site in the next; a cell that is both counts as site."""
    trace = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 31, 23, 59), 9), (1, dt.datetime(2024, 3, 2, 8), 5),
         (2, dt.datetime(2024, 1, 1, 8), 7), (2, dt.datetime(2024, 1, 1, 9), 5),
         (3, dt.datetime(2024, 1, 1, 8), 9), (3, dt.datetime(2024, 1, 1, 9), None), (3, dt.datetime(2024, 1, 1, 10), 5)],
        "user_id bigint, start_dt timestamp_ntz, cell_id int")
    got = arrival_paths(trace, spark.createDataFrame([(5,), (7,)], "source_cell_id int"),
                        spark.createDataFrame([(9,), (7,)], "cell_id int"))
    assert sorted(map(tuple, got.collect())) == [
        (dt.date(2024, 1, 1), 2, 0, 0, 1), (dt.date(2024, 1, 1), 3, 0, 1, 0), (dt.date(2024, 1, 31), 1, 0, 0, 0),
        (dt.date(2024, 3, 2), 1, 1, 0, 0)]
