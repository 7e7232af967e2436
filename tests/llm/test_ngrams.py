"""N-grams of blocks: small intermediate arrays, the same results in any number of parts."""

from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter

import numpy as np

from footfall.llm import ngrams as N
from footfall.llm.common import prepare


def _block(n: int) -> tuple[bytes, np.ndarray]:
    rnd = random.Random(5)
    texts = [b"", b" \n"] + [b" ".join(b"w%d" % rnd.randrange(50_000) for _ in range(rnd.randrange(400))) for _ in range(n)]
    return b"\n".join([*texts, b""]), np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)


def test_block_takes_few_times_its_bytes():
    text, ends = _block(6000)
    good, half = np.zeros(len(ends), np.uint64), 1 << (N.HASH_BITS - 1)
    N.word_hashes(np.frombuffer(b"a", np.uint8), np.array([0]), np.array([1]))   # tables made once
    tracemalloc.start()
    keyed, n = N.chosen_ngrams(text, ends, good, 0, half // 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 7 * len(text)       # about 13 times when made from the whole block at once
    grams, doc = N.block_ngrams(text, ends)
    assert Counter(dict(zip((keyed >> np.uint64(1)).tolist(), n.tolist()))) == Counter(grams[grams < half // 2].tolist())
    assert len(doc) * 2 == len(grams)


def test_chunks_do_not_change_ngrams(monkeypatch):
    text, ends = _block(300)
    grams, doc = N.block_ngrams(text, ends)
    monkeypatch.setattr(N, "CHUNK", 100)
    small, small_doc = N.block_ngrams(text, ends)
    assert (grams == small).all() and (doc == small_doc).all()
    weight = np.arange(len(np.unique(grams)), dtype=np.float32)
    every = 1 << N.HASH_BITS
    assert (N.gram_weights(grams, weight, 0, every) == np.unique(grams, return_inverse=True)[1]).all()


def test_sums_by_halves_equal_plain_sums(spark):
    prepare(spark)
    rnd = random.Random(9)
    texts = [None, "", " ", "a"] + [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 30))) for _ in range(60)]
    rows = [(i, -i, rnd.choice((0, N.TARGET, N.CALIBRATES)), t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "_k1 long, _k2 long, flags int, text string")

    def grams(t):
        w = (t or "").split()
        return w + list(zip(w, [*w[1:], None]))

    raw = Counter(g for r in rows for g in grams(r[3]))
    good = Counter(g for r in rows if r[2] == N.TARGET for g in grams(r[3]))
    want = {r[0]: (r[2], sum(math.log1p(good[g]) - math.log1p(raw[g]) for g in grams(r[3])), len(grams(r[3])))
            for r in rows if grams(r[3])}
    constant = math.log(sum(raw.values()) + len(raw)) - math.log(sum(good.values()) + len(raw))
    for block_bytes, range_bytes, passes in ((1 << 20, 1 << 20, 4), (200, 50, 4), (200, 50, 3), (100, 20, 8)):
        sums, got = N.log_ratio_sums(docs.repartition(3), block_bytes, range_bytes, passes)
        found = {r["_k1"]: r for r in sums.collect()}
        assert got == constant and found.keys() == want.keys()
        for k, (flags, s, n) in want.items():
            assert found[k]["flags"] == flags and found[k]["_n"] == n and abs(found[k]["_s"] - s) < 1e-4
