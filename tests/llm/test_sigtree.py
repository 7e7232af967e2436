"""The signature tree join against all pairs of sets."""

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from footfall.llm import sigtree  # noqa: E402
from footfall.llm.common import prepare  # noqa: E402

SCHEMA = "doc_id long, text string, node long, label string, token long, band int, n long"


def shingles(text, width):
    w = (text or "").encode().lower().split()
    n = min(width, len(w))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()


def plain(rows, width, percent):
    """Smallest id of each row's component, in the order of rows."""
    sets, label = [shingles(r[1], width) for r in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    ids = {}
    for x, r in zip(label, rows):
        ids.setdefault(x, []).append(r[0])
    least = {x: min((i for i in v if i is not None), default=None) for x, v in ids.items()}
    return sorted(((r[0], len(s), least[x] if s else r[0]) for r, s, x in zip(rows, sets, label)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def varied(seed, n, words=(3, 12, 150), spoil=14):
    """Documents of some bases, with all degrees of likeness, shared passages and odd rows."""
    rnd = random.Random(seed)
    bases = [[f"b{k}_{i}" for i in range(rnd.choice(words))] for k in range(n // 12)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(n):
        text = list(rnd.choice(bases))
        for _ in range(rnd.randrange(0, spoil) * len(text) // 150):
            text[rnd.randrange(len(text))] = f"x{rnd.randrange(10 ** 6)}"
        if rnd.random() < .4:
            text = text[:rnd.randrange(1, len(text) + 1)] + passage + text[len(text) // 2:]
        rows.append((i if rnd.random() < .95 else None, " ".join(text)))
    rows += [rows[0], rows[1], (10 ** 6, None), (10 ** 6 + 1, ""), (10 ** 6 + 2, " \n"), (10 ** 6 + 3, "A b C d"),
             (10 ** 6 + 4, "a B c D"), (10 ** 6 + 5, "a b"), (10 ** 6 + 6, "A\tB"), (10 ** 6 + 7, rows[2][1])]
    return [(*r, 7, "clash", 5, 5, 5) for r in rows]


@pytest.mark.parametrize("width,percent,hot,block", [(4, 85, 512, 4096), (4, 85, 3, 8), (5, 80, 20, 30)])
def test_components(spark, monkeypatch, width, percent, hot, block):
    prepare(spark)
    monkeypatch.setattr(sigtree, "HOT", hot)
    monkeypatch.setattr(sigtree, "BLOCK", block)
    monkeypatch.setattr(sigtree, "KEPT_LEAST", 4)
    rows = varied(hot, 160)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = found(sigtree.jaccard_components(docs, width, percent))
    assert got == plain(rows, width, percent)
    assert 10 < len({r[2] for r in got}) < 140
    if block == 8:
        assert sigtree.jaccard_components(docs.where("false"), width, percent).count() == 0


def test_crowd_of_near_copies_and_outsiders(spark, monkeypatch):
    """One group of near copies in many blocks, with members just above and below the threshold."""
    prepare(spark)
    monkeypatch.setattr(sigtree, "BLOCK", 16)
    rows = varied(2, 150, words=(150,), spoil=9)
    base = [f"w{i}" for i in range(150)]
    rnd = random.Random(1)
    for i in range(150):
        text = list(base)
        for _ in range(rnd.choice([1, 2, 3, 12])):
            text[rnd.randrange(150)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((2000 + i, " ".join(text), 7, "", 5, 5, 5))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(sigtree.jaccard_components(docs, 4, 85)) == plain(rows, 4, 85)


def test_full_sets_are_sent_once_for_equal_members(spark, monkeypatch):
    """Pairs below the threshold that share many rare shingles, in groups that others make different."""
    original, sent = sigtree._links, []

    def watched(rows, percent):
        members = {}
        for r in rows.select("token", "band", "i", "j", "node").collect():
            members.setdefault(tuple(r)[:4], set()).add(r["node"])
        sent.append([(at[1], frozenset(m)) for at, m in members.items()])
        return original(rows, percent)

    monkeypatch.setattr(sigtree, "_links", watched)
    prepare(spark)
    rows = []
    for k in range(12):
        base = [f"b{k}_{i}" for i in range(150)]
        for i, changed in enumerate(([20], [60, 100])):  # 135 of 159 shingles in common
            text = [f"x{i}" if m in changed else w for m, w in enumerate(base)]
            rows.append((100 * k + i, " ".join(text), 7, "", 5, 5, 5))
        for i in range(12):  # each shares some shingles with both
            at = 12 * i
            text = [f"y{k}_{i}_{m}" for m in range(140)] + base[at:at + 12]
            rows.append((100 * k + 10 + i, " ".join(text), 7, "", 5, 5, 5))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(sigtree.jaccard_components(docs, 4, 85)) == plain(rows, 4, 85)
    assert any(sent) and all(len(groups) == len(set(groups)) for groups in sent)


def test_whole_bitmaps_only_for_likely_members(spark, monkeypatch):
    """Texts that share a passage and little else are sorted out by bitmaps of a quarter of the width."""
    original, sent = sigtree._partnered, []

    def watched(dealt, signatures, percent):
        sent.append((dealt.count(), max((len(r["bits"]) for r in signatures.collect()), default=0)))
        return original(dealt, signatures, percent)

    monkeypatch.setattr(sigtree, "_partnered", watched)
    prepare(spark)
    rows = []
    for i in range(40):
        text = [f"w{i}_{m}" for m in range(280)] + [f"p{m}" for m in range(30)]
        rows.append((i, " ".join(text), 7, "", 5, 5, 5))
    rows.append((50, " ".join(["changed", *text[1:]]), 7, "", 5, 5, 5))  # a near copy of the last one
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(sigtree.jaccard_components(docs, 4, 85)) == plain(rows, 4, 85)
    first, then = sent[::2], sent[1::2]
    assert len(first) == len(then) == 3 and first[0][0] >= 41
    assert first[0][1] * sigtree.NARROW == max(bits for _, bits in then)
    assert 4 * sum(n for n, _ in then) < sum(n for n, _ in first)


@pytest.mark.parametrize("percent", [50, 85])
def test_tree_finds_all_pairs(percent):
    """The traversal gives every linked pair of different labels, and exactness is up to the sets."""
    rng = np.random.default_rng(percent)
    base = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
    sets = []
    for _ in range(200):
        s = base[:rng.integers(20, 60)].copy() if rng.random() < .7 else rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
        s[rng.integers(0, len(s), rng.integers(0, 12))] = rng.integers(0, 2 ** 63, 1, dtype=np.uint64)
        sets.append(np.unique(s))
    sizes = np.array([len(s) for s in sets])
    words = np.stack([sigtree.bitmap(s, 128) for s in sets])
    heads = np.array([s[0] for s in sets]).view(np.int64)
    labels, own = np.arange(200), rng.random(200) < .8
    tree = sigtree.SignatureTree(sizes, heads, words, labels, own, percent)
    got = {tuple(sorted((int(tree.order[a]), int(tree.order[b])))) for x, y in tree.traverse() for a, b in zip(x, y)}
    linked = {(i, j) for j in range(200) for i in range(j)
              if (b := len(np.intersect1d(sets[i], sets[j]))) * 100 >= percent * (sizes[i] + sizes[j] - b)}
    assert {p for p in linked if own[list(p)].any()} <= got
    assert len(got) < 200 * 199 // 2
    with_partner = {i for p in linked if own[list(p)].any() for i in p}
    assert with_partner <= set(sigtree.SignatureTree(sizes, heads, words, labels, own, percent).partnered().tolist())
    label = list(range(200))
    for a, b in sigtree.SignatureTree(sizes, heads, words, labels, np.ones(200, bool), percent).links(sets):
        assert tuple(sorted((int(a), int(b)))) in linked
        label = [label[a] if x == label[b] else x for x in label]
    for i, j in linked:
        assert label[i] == label[j]


def test_fold_is_the_narrower_bitmap():
    s = np.random.default_rng(3).integers(0, 2 ** 63, 300, dtype=np.uint64)
    for bits in (64, 256, 2048):
        assert (sigtree.fold(sigtree.bitmap(s, 4096), bits) == sigtree.bitmap(s, bits)).all()


def test_bands_of_partners_are_neighbours():
    for percent in (80, 85):
        n = np.arange(1, 30000)
        lowest = sigtree.band_of(sigtree.least_overlap(n, percent), percent)
        assert (sigtree.band_of(n, percent) - lowest <= 1).all()


def test_first_shingles():
    low = np.arange(0, 400, 10, dtype=np.uint64)
    none = (np.empty(0, np.uint64), np.empty(0, np.int64))
    assert sigtree.first_shingles(low, 100, none, 85).tolist() == low[:16].tolist()
    hot = (np.array([0, 20, 50], np.uint64), np.array([9, 4, 6]))
    assert sigtree.first_shingles(low, 100, hot, 85).tolist() == [x for x in low.tolist() if x not in (0, 20, 50)][:16]
    assert sigtree.first_shingles(low[:17], 100, hot, 85) is None
    assert sigtree.first_shingles(low[:6], 6, hot, 50).tolist() == [10, 30, 40, 20]


def test_sieve_keeps_all_keys_and_few_others(spark):
    from footfall.llm.common import written
    from footfall.llm.sieve import Sieve

    prepare(spark)
    keys = written(spark.range(0, 40000, 2).selectExpr("id AS a", "cast(id % 7 AS int) AS b"), "keys")
    rows = spark.range(40000).selectExpr("'x' AS __a", "id AS a", "cast(id % 7 AS int) AS b")
    left = Sieve(keys).rows(rows, "a", "b")
    assert left.columns == rows.columns
    ids = {r["a"] for r in left.collect()}
    assert {*range(0, 40000, 2)} <= ids and len(ids) < 24000
    assert Sieve(keys.where("false")).rows(rows, "a", "b").count() == 0
