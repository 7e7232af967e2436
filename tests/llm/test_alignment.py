"""The alignment of two tokenizers against the libraries and a walk over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402

from footfall.llm import alignment  # noqa: E402
from footfall.llm.common import prepare  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids_a string, links string, n_a int"
TEXTS = [None, "", " ", "x", "a b c", "Hello world, don't stop", "two  spaces and\ttabs\n\nlines ", " leading and trailing ",
         "日本語 のテキスト é ü ß 😀😀", "<|endoftext|> </s> <s> <0x0A> [INST]", "▁ mark ▁of a space", "a b　c   d",
         "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa " * 20, "\x00\x01\x1c odd \x1f controls\x7f", "ﬁ ligature Ⅷ ½",
         "İstanbul ǅ ǆ", "tab\tinside words\there", "end\n", "\nstart", "a" * 5000, "hello world " * 3]


def walk(text, library, model, bytes_a, bytes_b):
    """Ids, groups as lists, by comparing the ends of all tokens."""
    if not text:
        return [], [], []
    a = library.encode(" " + text, add_special_tokens=False).ids
    b = model.encode(text)
    whole = (" " + text).encode()
    if b"".join(bytes_a[i] for i in a) != whole or b"".join(bytes_b[i] for i in b) != whole:
        return [], [], []
    ends_a, ends_b = ([sum(len(t[i]) for i in ids[:k + 1]) for k in range(len(ids))] for t, ids in ((bytes_a, a), (bytes_b, b)))
    groups, x, y = [], [], []
    at = 0
    for i, e in zip(a, ends_a):
        x.append(i)
        if e in set(ends_b):
            while at < len(b) and ends_b[at] <= e:
                y.append(b[at])
                at += 1
            groups.append((x, y))
            x, y = [], []
    return a, b, groups


def test_alignment(spark):
    import sentencepiece
    from tokenizers import Tokenizer

    prepare(spark)
    rnd = random.Random(5)
    words = ["the", "Foo,", "bar!", "é", "日本", "don't", "12345", "re-do", "x_y", "naïve", "##", "</s>"]
    texts = TEXTS + [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60))) for _ in range(60)]
    rows = [(i if i % 11 else None, t, "clash", "clash", 1) for i, t in enumerate(texts)] + [(3, "x", "", "", 0)]
    library, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    both = alignment.aligner(A, B)
    plain = [walk(t, library, model, both.bytes_a, both.bytes_b) for _, t, *_ in rows]
    pairs = Counter((x[-1], y[-1]) for _, _, groups in plain for x, y in groups)
    highest = Counter()
    for (_, y), n in pairs.items():
        highest[y] = max(highest[y], n)
    want = []
    for (i, *_), (a, b, groups) in zip(rows, plain):
        ends = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        want.append((i, len(a), len(b), len(groups), len(ends), sum(pairs[p] == highest[p[1]] for p in ends),
                     sum(pairs[p] for p in ends), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [tuple(r) for r in alignment.align_digests(docs, A, B).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(not w[1] for w in want) >= 3 and sum(w[1] > 0 for w in want) > 60
    assert alignment.align_digests(docs.where("false"), A, B).count() == 0
    spans = {r["text"]: r for r in alignment.aligned(docs, A, B, keep=["text"]).collect()}
    for (_, t, *_), (a, b, groups) in zip(rows, plain):
        r = spans[t]
        assert (r["ids_a"], r["ids_b"]) == (a, b)
        assert [len(x) for x, _ in groups] == np.diff([0, *r["ends_a"]]).tolist()
        assert [len(y) for _, y in groups] == np.diff([0, *r["ends_b"]]).tolist()


def test_every_linked_pair_is_known():
    """Pairs of ids that end together are in the list made from the vocabularies."""
    both = alignment.aligner(A, B)
    for t in TEXTS:
        a, b = both.encode(pa.array([t], pa.string()))[0]
        ra, rb = both.align(a, b)
        codes = a[ra] << 32 | b[rb]
        assert (both.pairs[both.links(a[ra], b[rb])] == codes).all()


def test_remembered_parts_change_nothing(monkeypatch):
    """Ids of a text are the same with and without remembered parts, also when these are dropped."""
    monkeypatch.setattr(alignment, "CACHE_ENTRIES", 3)
    both = alignment.Aligner(A, B)
    rnd = random.Random(8)
    letters = ["a", "b", " ", " ", "\n", "\t", "é", "日", "'", "1", "▁", "<", "s", ">", " ", "-", "😀"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 40))) for _ in range(400)]
    fast = [both.encode(pa.array([t]))[0] for t in texts]
    both.units_are_apart = False
    for t, (a, b) in zip(texts, fast):
        x, y = both.encode(pa.array([t]))[0]
        assert a.tolist() == x.tolist() and b.tolist() == y.tolist()


def test_gallop_equals_bisection():
    rng = np.random.default_rng(0)
    for _ in range(400):
        a, b = (np.unique(rng.integers(0, rng.integers(1, 300), rng.integers(0, 80))) for _ in range(2))
        if len(b):
            assert (alignment.gallop(a, b) == np.searchsorted(b, a)).all()
        x, y = alignment.common_ends(a, b)
        assert (a[x] == np.intersect1d(a, b)).all() and (b[y] == a[x]).all()


def test_tokens_without_bytes_end_nowhere():
    both = alignment.aligner(A, B)
    a, b = np.array([5, 6, 7]), np.array([300, 301])
    monkey = alignment.Aligner.__new__(alignment.Aligner)
    monkey.len_a, monkey.len_b = both.len_a.copy(), both.len_b.copy()
    monkey.len_a[[5, 6, 7]] = [2, 0, 1]
    monkey.len_b[[300, 301]] = [2, 1]
    ra, rb = monkey.align(a, b)
    assert (ra.tolist(), rb.tolist()) == ([0, 2], [0, 1])
