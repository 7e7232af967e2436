"""Targets of many sources against filling up source by source."""

from __future__ import annotations

import random

import pytest

from footfall.llm import mixing


def plain(sizes, weights=(5, 2, 1), share=1.0, most=3.0):
    """Deal the total by weight; what sources cannot take goes round again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, free = {}, sum(sizes.values()) * share, set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > most * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        target |= {s: most * sizes[s] for s in full}
        left, free = left - sum(most * sizes[s] for s in full), free - full
    return target


@pytest.mark.parametrize("seed,n,share", [(1, 1, 1.0), (2, 5, 1.0), (3, 700, 1.0), (4, 700, 0.3), (5, 300, 2.9), (6, 4, 9.0)])
def test_targets(spark, seed, n, share):
    rnd = random.Random(seed)
    names = [f"h{k}.é" if k % 2 else f"H{k}" for k in range(n - 1)] + [None]
    sizes = {s: rnd.choice([0, 1, 1, 7, rnd.randrange(10 ** rnd.randrange(1, 7))]) for s in names}
    table = spark.createDataFrame([(s, z, 1) for s, z in sizes.items()], "source string, source_size long, n_rows long")
    got = {r["source"]: r["target"] for r in mixing.targets(table, share=share).collect()}
    want = plain(sizes, share=share)
    assert set(got) == set(want) and all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)


def test_no_sources(spark):
    assert mixing.targets(spark.createDataFrame([], "source string, source_size long, n_rows long")).count() == 0


def test_rows_without_words_are_never_taken(spark):
    docs = spark.createDataFrame([(None, None, "a")] * 30 + [(None, " \t", None)] * 30 + [(k, "one two", "a") for k in range(5)],
                                 "doc_id long, text string, source string")
    assert sorted(r["doc_id"] for r in mixing.mixed_corpus(docs).collect()) == list(range(5))
