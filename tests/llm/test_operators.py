"""The training-data operators against brute force, on texts with nulls, ties and copies."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from footfall.llm import (bpe, chat, classifier, fingerprint, hyperminhash, mixing, quality, repeats,  # noqa: E402
                          suffixarray, suffixtree, tokenbin)
from footfall.llm.common import prepare  # noqa: E402
from footfall.plans.sinks import scratch_table_path  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, label string"


def texts():
    rnd = random.Random(4)
    words = ["the", "of", "Foo", "bar!", "é", "x", "#a", "日本", "don't", "12"]
    base = [" ".join(rnd.choice(words) for _ in range(n)) for n in (0, 1, 2, 5, 12, 40, 80, 200, 400)]
    long = base[-1]
    near = " ".join("changed" if i % 50 == 7 else w for i, w in enumerate(long.split(" ")))
    return [None, "", " \n\t ", *base, long, near, "intro " + base[-2] + " tail", base[-2], "a\n\nb\na\n b \na",
            "<|endoftext|>x  y　z", long + "\n" + long]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(i, t, "en", ["s1", "s2", None][i % 3], 0, 7, "clash") for i, t in enumerate(texts())]
    rows += [(None, "null id " * 30, "en", "s1", 0, 7, "clash")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def collected(df):
    return {r["doc_id"]: r for r in df.collect()}


def given(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.orderBy(F.col("doc_id").asc_nulls_first()).collect()]


def test_bpe_equals_library(docs, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    found = collected(bpe.round_trip_digests(docs, PATH))
    for i, t in given(docs):
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip_digests(none, PATH).count() == 0
    back = collected(bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH))
    assert all(back[i]["text"] == t for i, t in given(docs))


def test_long_pretokens_stream_in_windows():
    from tokenizers import Tokenizer

    library, merges, rnd = Tokenizer.from_file(PATH), bpe.merge_list(PATH), random.Random(1)
    for letters in ("a", "ab", "etaoinshrdlu", "=-"):
        t = "".join(rnd.choice(letters) for _ in range(6 * merges.window))
        assert list(merges.encode(t)) == library.encode(t, add_special_tokens=False).ids


def test_token_blocks(spark, docs, none):
    path = scratch_table_path(spark, "t")
    tokenbin.write_tokens(docs, PATH, path, block_ids=300)
    found = sorted(tokenbin.read_documents(spark, path).collect(), key=lambda r: r["start"])
    plain, start = bpe.encoder(PATH), 0
    import pyarrow as pa
    for (i, t), r in zip(given(docs), found, strict=True):
        ids = [*plain(pa.array([t]))[0].tolist(), 0]
        assert (r["doc_id"], r["start"], r["ids"]) == (i, start, ids)
        start += len(ids)
    path = scratch_table_path(spark, "t")
    tokenbin.write_tokens(none, PATH, path)
    assert tokenbin.read_documents(spark, path, tokenbin.crc32_of).count() == 0
    assert zlib.crc32(b"\x01\0\0\0") == tokenbin.crc32_of(np.array([1]))


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_pack_any_width(bits):
    x = np.random.default_rng(bits).integers(0, 2 ** bits, 1000, dtype=np.uint64)
    assert (tokenbin.unpack(tokenbin.pack(x, bits), bits, 70, 900) == x[70:970]).all()


def test_mix(docs, none):
    rows = mixing.mix_documents(docs, rows_per_range=3).collect()
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    total = sum(r["size"] for r in rows)
    cap = {s: 3 * x[0]["source_size"] for s, x in by.items()}
    weight = {"s1": 5, "s2": 2, None: 1}
    open_, want, left = set(cap), {}, float(total)
    while open_:
        w = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / w > cap[s]}
        if not full:
            want |= {s: left * weight[s] / w for s in open_}
            break
        want |= {s: cap[s] for s in full}
        left -= sum(cap[s] for s in full)
        open_ -= full
    for s, x in by.items():
        assert abs(x[0]["target"] - want[s]) < 1e-6 and abs(sum(r["taken"] for r in x) - want[s]) <= 0.5
    assert mixing.mix_documents(none).count() == 0
    assert mixing.mixed_corpus(docs).columns == docs.columns


def test_fingerprints(spark, none):
    t = spark.createDataFrame([("a b\nc d\na b", "c d\na b\na b", "x"), ("", None, "q r s"), ("one", "one", "")],
                              "a string, b string, c string")
    t = fingerprint.with_fingerprint(fingerprint.with_fingerprint(fingerprint.with_fingerprint(t, "f", "a"), "g", "b"),
                                     "h", "c")
    t = t.withColumns({"there": fingerprint.remove(fingerprint.add(F.col("f"), F.col("h")), F.col("h")),
                       "like": fingerprint.likeness(F.col("f"), F.col("g")),
                       "other": fingerprint.likeness(F.col("f"), F.col("h"))})
    for r in t.collect():
        assert r["f"] == r["g"] == r["there"] and r["like"] == 1.0 and r["f"] != r["h"] and 0 <= r["other"] < 1
        assert len(r["f"]) == fingerprint.LANES and all(0 <= x <= fingerprint.MASK for x in r["f"])
    assert fingerprint.with_fingerprint(none, "f", "text").count() == 0


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, none, width, percent):
    sets = {}
    for i, t in given(docs):
        w = t.encode().lower().split()
        n = min(width, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    parent = {i: i for i in sets if i is not None}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in parent:
        for j in parent:
            both = len(sets[i] & sets[j])
            if j < i and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    found = collected(hyperminhash.near_duplicates(docs, width, percent))
    for i in parent:
        assert (found[i]["n_shingles"], found[i]["component_id"], found[i]["kept"]) == (
            len(sets[i]), root(i), root(i) == i)
    assert found[None]["component_id"] is None and found[None]["kept"]
    assert hyperminhash.near_duplicates(none).count() == 0
    assert hyperminhash.keep_first(docs).columns == docs.columns


def test_keep_first_keeps_one_row_of_a_group(spark):
    """Null and repeated ids take no other rows with them, and no copy of a group stays."""
    def text(k, changed=None):
        return " ".join("changed" if i == changed else f"w{k}_{i}" for i in range(120))

    rows = [(1, text(0), "a"), (None, text(0, 60), "b"),  # near copy without an id
            (None, text(1), "c"), (None, text(2), "d"),  # clean, without an id
            (None, text(3), "e"), (None, text(3, 60), "f"), (None, text(3), "g"),  # a group without ids
            (5, text(4), "h"), (5, text(4), "i"), (5, text(4), "j"),  # one row three times
            (6, text(0, 30), "k"), (6, text(5), "l"),  # one id: a near copy and a clean text
            (7, None, "m"), (7, "", "n"), (None, " ", "o"), (None, None, "p")]  # nothing to compare
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    prepare(spark)
    kept = [r["source"] for r in hyperminhash.keep_first(docs).collect()]
    groups = ["a", "c", "d", "efg", "hij", "l", "m", "n", "o", "p"]
    assert sorted(next(g for g in [*groups, s] if s in g) for s in kept) == groups


def test_many_texts_without_id(spark):
    """Full sets are found by id and text: rows without an id do not meet each other's nodes."""
    prepare(spark)
    docs = spark.createDataFrame([(None, f"text number {i} of many") for i in range(50)], "doc_id long, text string")
    nodes = hyperminhash.signatures(docs, 5, 6, {"rep_text": hyperminhash.text_key()}).withColumn(
        "rep", F.lit(hyperminhash.NO_ID))
    sets = hyperminhash._full_sets(nodes.select("node"), nodes, docs, 5).collect()
    assert len(sets) == 50
    assert all(hyperminhash.node_of(np.frombuffer(r["shingles"], np.uint64)) == r["node"] for r in sets)


def test_bands_with_equal_members_are_one(spark):
    """The band of the first place stays, with all its members; bands of one node go."""
    place = 1 << hyperminhash.KEY_BITS
    held = {2 * place + 9: [1, 2], 3 * place + 1: [1, 2], place + 5: [4], 5 * place + 7: [1, 2, 3], 4 * place + 2: [2, 3]}
    rows = [(band, node) for band, nodes in held.items() for node in nodes]
    bands = spark.createDataFrame(rows, "band long, node long").repartition(3)
    got = sorted(map(tuple, hyperminhash.band_members(bands).select("band", "node", "lo").collect()))
    assert got == sorted((b, n, min(held[b])) for b in held if b not in (place + 5, 3 * place + 1) for n in held[b])


def test_full_sets_shuffle_wanted_texts_only(spark, monkeypatch):
    """Texts of other nodes are dropped before the join."""
    original, kept = hyperminhash.Sieve.rows, []

    def watched(self, df, *columns):
        out = original(self, df, *columns)
        kept.append((df.count(), out.count()))
        return out

    monkeypatch.setattr(hyperminhash.Sieve, "rows", watched)
    prepare(spark)
    docs = spark.createDataFrame([(i, f"text number {i} of many") for i in range(200)], "doc_id long, text string")
    nodes = hyperminhash.signatures(docs, 5, 6, {"rep_text": hyperminhash.text_key()}).withColumn("rep", F.col("doc_id"))
    wanted = nodes.where("doc_id < 5")
    got = hyperminhash._full_sets(wanted.select("node"), nodes, docs, 5).collect()
    assert {r["node"] for r in got} == {r["node"] for r in wanted.collect()} and len(got) == 5
    assert [before for before, _ in kept] == [200] and kept[0][1] < 20


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    """A large group of all degrees of likeness, whose bands are dealt out as many blocks."""
    monkeypatch.setattr(hyperminhash, "BLOCK", 8)
    rnd = random.Random(9)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(90):
        text = list(base)
        for _ in range(rnd.randrange(0, 12)):
            text[rnd.randrange(150)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    sets = [{tuple(w[k:k + 3]) for k in range(148)} for w in (t.split() for _, t in rows)]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    prepare(spark)
    found = collected(hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85))
    assert [found[i]["component_id"] for i in range(len(rows))] == label
    assert 1 < len(set(label)) < len(rows)


def test_crowd_of_near_copies_is_dealt_out_in_proportion(spark, monkeypatch):
    """Rows of blocks of one large group and some outsiders grow with its members, not with their square."""
    monkeypatch.setattr(hyperminhash, "BLOCK", 8)
    rnd, original, counts = random.Random(3), hyperminhash._by_blocks, []

    def watched(dealt, work, schema):
        if "shingles" not in dealt.columns:
            counts.append((dealt.count(), dealt.select("band", "node").distinct().count()))
        return original(dealt, work, schema)

    monkeypatch.setattr(hyperminhash, "_by_blocks", watched)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(240):  # places apart, so that any two of the group are linked through few others
        text = list(base)
        for _ in range(1 + i % 2 if i % 40 else 14):
            text[rnd.randrange(150)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    sets = [{tuple(w[k:k + 3]) for k in range(148)} for w in (t.split() for _, t in rows)]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    prepare(spark)
    found = collected(hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85))
    assert [found[i]["component_id"] for i in range(len(rows))] == label
    assert counts and all(dealt <= 4 * members for dealt, members in counts)


def test_intersections_in_parts(monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK_SHINGLES", 5)
    one, others = np.array([1, 4, 7], np.uint64), [[4, 9], [1, 2, 3, 4, 7, 8], [5], [7]]
    others = [np.array(x, np.uint64) for x in others]
    assert hyperminhash.intersections(one, others).tolist() == [1, 3, 0, 1]
    assert hyperminhash.intersections(one, []).tolist() == []


def marked(docs, length, split, first):
    seen, out = {}, {}
    rows = [(i, split(t)) for i, t in given(docs)]
    for i, x in rows:
        for s in range(len(x) - length + 1):
            seen.setdefault(tuple(x[s:s + length]), []).append((i, s))
    for i, x in rows:
        gone = [False] * len(x)
        for s in range(len(x) - length + 1):
            at = seen[tuple(x[s:s + length])]
            if at[0] != (i, s) if first else len(at) > 1:
                gone[s:s + length] = [True] * length
        out[i] = (x, gone)
    return out


@pytest.mark.parametrize("first,crowd", [(False, 2048), (True, 2048), (False, 1), (True, 1)])
def test_suffix_array(docs, none, first, crowd, monkeypatch):
    monkeypatch.setattr(suffixarray, "VARIANTS", crowd)
    found = collected(suffixarray.dedup_digests(docs, 40, 16, first))
    for i, (x, gone) in marked(docs, 40, lambda t: t.encode(), first).items():
        kept = bytes(c for c, g in zip(x, gone) if not g)
        assert (found[i]["n_bytes"], found[i]["n_removed"]) == (len(x), sum(gone))
        assert found[i]["n_spans"] == sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        assert found[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert suffixarray.dedup_digests(none, 40, 16, first).count() == 0
    assert suffixarray.without_repeats(docs, 40, 16).columns == docs.columns


@pytest.mark.parametrize("first", [False, True])
def test_crowded_anchors_without_a_row_per_window(spark, first, monkeypatch):
    """A line in many surroundings, some of them shared on one side or on both, some only near the line."""
    monkeypatch.setattr(suffixarray, "VARIANTS", 4)
    rnd, original, rows_of_parts = random.Random(8), suffixarray.parts, []

    def watched(*args):
        rows_of_parts.append(original(*args).count())
        return original(*args)

    monkeypatch.setattr(suffixarray, "parts", watched)

    def noise(n):
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))

    line, sides, rows = noise(90), [noise(150) for _ in range(3)], []
    for i in range(120):
        before, after = (rnd.choice(sides) if rnd.random() < .3 else noise(150) for _ in "ab")
        cut = rnd.randrange(0, 60)
        before = noise(150 - cut) + rnd.choice(sides)[150 - cut:] if rnd.random() < .3 else before
        rows.append((i, before + line + after))
    rows += [(5, rows[5][1]), (None, rows[7][1]), (200, rows[9][1] + rows[10][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    prepare(spark)
    found = sorted((r["n_removed"], r["kept_sha256"]) for r in suffixarray.dedup_digests(
        docs.where("doc_id is not null and doc_id <> 5"), 120, 16, first).collect())
    texts = marked(docs.where("doc_id is not null and doc_id <> 5"), 120, lambda t: t.encode(), first)
    assert found == sorted((sum(gone), hashlib.sha256(bytes(c for c, g in zip(x, gone) if not g)).hexdigest())
                           for x, gone in texts.values())
    assert any(n for n, _ in found) and rows_of_parts and max(rows_of_parts) <= 6 * len(rows)
    if not first:  # rows that come twice, and one without an id
        seen = Counter(t[k:k + 120] for _, t in rows for k in range(len(t) - 119))
        for r in suffixarray.dedup_digests(docs, 120, 16, False).collect():
            t = next(t for i, t in rows if i == r["doc_id"])
            gone = {k + m for k in range(len(t) - 119) if seen[t[k:k + 120]] > 1 for m in range(120)}
            assert r["n_removed"] == len(gone)


def test_ranges_of_repeated_rows_are_held_once(spark, monkeypatch):
    """Many rows equal in id and text put one document's ranges in an array, not one per row."""
    rnd, seen = random.Random(5), []
    text = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    rows = spark.createDataFrame([(1, text)] * 50 + [(2, text)], "doc_id long, text string")
    prepare(spark)
    original = repeats.repeated_ranges

    def watched(*args):
        seen.extend(original(*args).collect())
        return original(*args)

    for module in (repeats, suffixarray):
        if hasattr(module, "repeated_ranges"):
            monkeypatch.setattr(module, "repeated_ranges", watched)
    out = suffixarray.dedup_digests(rows, 40, 16, False).collect()
    assert len(out) == 51 and all(r["n_removed"] == r["n_bytes"] == 300 for r in out)
    by = {r["id"]: r["ranges"] for r in seen}
    assert sorted(by[1]) == sorted(by[2]) and len(by[1]) == len({tuple(x) for x in by[1]})


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_suffix_tree(docs, none, crowd, monkeypatch):
    monkeypatch.setattr(suffixtree, "SUFFIXES", crowd)
    found = collected(suffixtree.dedup_digests(docs, 20, 8))
    for i, (x, gone) in marked(docs, 20, lambda t: t.encode().split(), True).items():
        kept = b" ".join(w for w, g in zip(x, gone) if not g)
        assert (found[i]["n_words"], found[i]["n_removed"]) == (len(x), sum(gone))
        assert found[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert suffixtree.dedup_digests(none).count() == 0


def test_small_groups_of_suffixes_are_cut_in_the_task(docs, monkeypatch):
    """What is dealt out for anchors of few suffixes is their pieces of text, not a row per suffix."""
    def dealt(*_):
        raise AssertionError("a row per suffix")

    monkeypatch.setattr(suffixtree, "suffixes", dealt)
    found = collected(suffixtree.dedup_digests(docs, 20, 8))
    for i, (x, gone) in marked(docs, 20, lambda t: t.encode().split(), True).items():
        assert found[i]["n_removed"] == sum(gone)


def test_groups_stay_whole_and_flags_become_ranges():
    rows = pa.record_batch({"k": pa.array([1, 1, 2, 2, 2, 3, 3, 4], pa.int64())})
    parts = [t["k"].to_pylist() for t in repeats.whole_groups(iter([rows.slice(i, 2) for i in range(0, 8, 2)]), "k", 2)]
    assert sum(parts, []) == rows["k"].to_pylist()
    assert all(not set(a) & set(b) for i, a in enumerate(parts) for b in parts[i + 1:]) and len(parts) > 1
    found = repeats.starts_batch(np.array([7, 8, 9]), np.array([1, 2, 3]), np.array([3, 2, 4]),
                                 np.array([0, 1, 1, 0, 0, 1, 0, 1, 1], bool)).to_pylist()
    assert found == [{"anchor": 7, "variant": 1, "starts": [{"from": 1, "until": 3}]},
                     {"anchor": 9, "variant": 3, "starts": [{"from": 0, "until": 1}, {"from": 2, "until": 4}]}]


@pytest.mark.parametrize("first", [True, False])
def test_repeated_windows_of_some_anchors(first):
    """Pieces of several anchors in one table; places are ordered by id, text and start."""
    rnd, kind = random.Random(6), repeats.Symbols(False, 8, 4)
    for _ in range(40):
        rows = [{"anchor": a, "variant": v, "id": rnd.randint(0, 3), "tk": rnd.randint(0, 1), "lo": 50 * (4 * a + v),
                 "n": (n := rnd.randint(1, 12)), "piece": bytes(rnd.choice(b"ab") for _ in range(n + 7))}
                for a in range(rnd.randint(1, 4)) for v in range(rnd.randint(1, 4))]
        table = pa.Table.from_pylist(rows)
        found = {(r["anchor"], r["variant"]): {i for s in r["starts"] for i in range(s["from"], s["until"])}
                 for r in suffixarray.repeated_windows(table, kind, first).to_pylist()}
        for r in rows:
            for i in range(r["n"]):
                at = [(q["id"], q["tk"], q["lo"] + j) for q in rows if q["anchor"] == r["anchor"]
                      for j in range(q["n"]) if q["piece"][j:j + 8] == r["piece"][i:i + 8]]
                wanted = min(at) < (r["id"], r["tk"], r["lo"] + i) if first else len(at) > 1
                assert (i in found.get((r["anchor"], r["variant"]), ())) == wanted


def test_suffix_order_and_previous_factors():
    rnd = random.Random(2)
    for _ in range(60):
        x, limit = np.array([rnd.randrange(2) for _ in range(rnd.randrange(1, 60))]), rnd.choice([1, 3, 16])
        order, lcp = suffixarray.suffix_array(x, limit)
        found = np.empty(len(x), int)
        found[order] = suffixarray.lpf(order, lcp, np.arange(len(x)))

        def shared(a, b):
            n = 0
            while max(a, b) + n < len(x) and x[a + n] == x[b + n] and n < limit:
                n += 1
            return n

        assert found.tolist() == [max((shared(i, j) for j in range(i)), default=0) for i in range(len(x))]


def test_base_statistics(docs, none):
    found = collected(quality.base_statistics(docs))
    for i, t in given(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        hit = set()
        for k, g in enumerate(grams):
            if grams.count(g) > 1:
                hit.update(range(k, k + 5))
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(hit) > 20 * len(w))
    assert quality.base_statistics(none).count() == 0


def test_quality_and_classifier_with_few_labels(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    for t, n in ((labels, docs.count()), (labels.where("false"), docs.count())):
        assert quality.judge(docs, t).count() == n
        scores = classifier.score(docs, *classifier.train(docs, t)).collect()
        assert len(scores) == n and all(0 <= r["score"] <= 1 for r in scores)
    assert quality.judge(none, labels).count() == 0
    assert classifier.score(none, *classifier.train(none, labels)).count() == 0


@pytest.mark.parametrize("block, part, passes", [(1 << 24, 1 << 23, 2), (2000, 500, 3), (1, 1 << 23, 1)])
def test_quality_scores(spark, docs, block, part, passes, monkeypatch):
    """Scores, threshold and verdict from plain counts of n-grams, however texts and hashes are cut."""
    for name, value in (("BLOCK_BYTES", block), ("RANGE_BYTES", part), ("PASSES", passes)):
        monkeypatch.setattr(quality.ngrams, name, value)
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    extra = [(100 + i, " ".join(rnd.choice(words) for _ in range(60))) for i in range(60)]
    extra += [(200 + i, " ".join(rnd.choice(["junk", "zz", "qq", "w1"]) for _ in range(60))) for i in range(5)]
    extra += [(101, "other text of a known id"), extra[3], extra[3], (None, "null id w1 w2")]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100, 160)] + [(100, 1, 0), (200, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    calibrates = {r["_id"]: r["_calibrates"] for r in quality.trusted_ids(labels).collect()}
    assert set(calibrates) == set(range(100, 160))

    def grams(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        return [(x,) for x in w] + list(zip(w, [*w[1:], ""]))

    raw, good, rows = Counter(), Counter(), [tuple(r) for r in table.collect()]
    for i, t in rows:
        raw.update(grams(t))
        good.update(grams(t) if calibrates.get(i) is False else [])
    r, g, v = sum(raw.values()), sum(good.values()), len(raw)
    score = {(i, t): sum(np.log((good[x] + 1) / (g + v) / ((raw[x] + 1) / (r + v))) for x in grams(t))
             / (len(grams(t)) + quality.SHRINK) for i, t in rows if grams(t)}
    held = [s for (i, _), s in score.items() if calibrates.get(i)]
    median, low = np.percentile(held, [50, 1])
    least = median - 2 * (median - low)
    judged = quality.judge(table.withColumn("t", F.lit(0)), labels)
    found = quality.verdicts(table, labels).join(
        table.withColumns(quality.row_keys()).distinct(), ["_k1", "_k2"]).collect()
    assert len(found) == len(score) and judged.count() == len(rows)
    for x in found:
        want = score[x["doc_id"], x["text"]]
        assert abs(x["score"] - want) < 1e-5
        assert x["good"] == (want >= least) or abs(want - least) < 1e-5
    assert {x["good"] for x in found} == {True, False}


CLASHES = ["_k1", "_k2", "_id", "_i", "_tk", "_n", "_ranges", "_copy", "score", "node", "flags", "id", "Text"]


@pytest.mark.parametrize("stage", [
    lambda docs, labels: quality.keep_good(docs, labels), lambda docs, labels: hyperminhash.keep_first(docs),
    lambda docs, labels: suffixarray.without_repeats(docs, 40, 16), lambda docs, labels: mixing.mixed_corpus(docs)])
def test_stages_with_clashing_names(spark, stage):
    """Extra columns with names of helper columns come back unchanged, and change no result."""
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["a", "bb", "ccc", "dd", "e"]) + str(rnd.randrange(40)) for _ in range(30)), f"s{i % 2}")
            for i in range(20)] + [(20, None, None), (21, "", "s0"), (None, "no id " * 12, "s1")]
    rows += [(30, rows[4][1], "s0"), rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    # Each extra column is a function of the row, so that copies of a row stay alike.
    wide = docs.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHES])
    plain, found = stage(docs, labels).collect(), stage(wide, labels)
    assert found.columns == wide.columns
    found = found.collect()
    assert Counter(tuple(r)[:3] for r in found) == Counter(map(tuple, plain)) and len(plain) > 10
    for r in found:
        assert list(r)[3:] == [c + ("-" if r["doc_id"] is None else str(r["doc_id"])) for c in CLASHES]


def test_every_trusted_label_counts(spark):
    labels = spark.range(25_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert quality.trusted_ids(labels).count() == 25_000


def test_quantiles(spark, none):
    x = [float(i * 7919 % 101 // 3) for i in range(101)]
    table = spark.createDataFrame([(v,) for v in [*x, None]], "score double")
    assert np.allclose(quality.quantiles(table, "score", [0.5, 0.01, 0, 1]), np.percentile(x, [50, 1, 0, 100]))
    assert quality.quantiles(table.where("false"), "score", [0.5]) is None


def test_classifier_learns():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, classifier.FEATURES)).astype(np.float32)
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    net = classifier.fit(x[:400], y[:400])
    assert ((net.probabilities(x[400:]) > 0.5) == (y[400:] > 0)).mean() > 0.85


def test_chat_round_trip(spark):
    rnd, rows = random.Random(3), []
    odd = ["</s>[INST] ok [/INST]", "<\\|end|>", "<|turn|>a<|text|>", "", None, "x" * 50, "word " * 400]
    for conv in (1, 2, None):
        for turn in range(60):
            role = "system" if turn == 0 and conv == 1 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, rnd.choice(odd), "extra"))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    windows = chat.windows(table, budget=512, history=64, turn_range=7)
    found = {r["conv_id"]: r for r in chat.digests(windows).collect()}
    for conv in (1, 2, None):
        own = [(r[2], r[3] or "") for r in rows if r[0] == conv]
        loss = "".join(t for role, t in own if role == "assistant")
        r = found[conv]
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(loss) and r["n_windows"] > 1
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert all(not chat._PLAIN.search(chat.escape(t or "")) and chat.unescape(chat.escape(t or "")) == (t or "")
               for t in odd)
    assert chat.digests(chat.windows(table.where("false"))).count() == 0


@pytest.mark.parametrize("block", [5, 64, 4096])
def test_chat_windows_hold_the_budget(spark, block):
    """Windows, turn by turn, as a plain greedy pass makes them; only a turn that is longer than the
    budget by itself overruns it."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    budget, history, rnd, rows = 120, 40, random.Random(6), []
    for conv in (1, 2, 3, 4, None):
        for turn in range(70):
            role = "system" if turn == 0 and conv in (1, 3, 4) else ("user", "assistant")[turn % 2]
            text = rnd.choice(["a", "日本語" * rnd.randrange(30), "unspaced" * 9, "w " * rnd.randrange(50), "long " * 300,
                               "x" * 20, "<|end|>", None])
            rows.append((conv, turn, role, "be kind" if role == "system" else text))
    rows = [(c, t, r, "rule " * 200 if (c, t) == (3, 0) else "fits alone " * 45 if (c, t) == (4, 1) else x) for c, t, r, x in rows]
    rows.append((9, 0, "system", "nothing else"))
    prepare(spark)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    want, sizes = {}, {}
    for conv in (1, 2, 3, 4, None, 9):
        own = [r for r in rows if r[0] == conv]
        n = [len(library.encode(chat.formatted_turn(r[2], r[3] or ""), add_special_tokens=False).ids) for r in own]
        system = n[0] if own[0][2] == "system" else 0
        i = first = int(system > 0)
        if system:
            want[conv, 0] = [(0, 0)]
        while i < len(own):
            fits = n[i] + system <= budget
            window = 0 if i == 1 and system and fits else i
            shown = [(0, 0)] if system and fits else []
            used, back = n[i] + (system if fits else 0), i
            while fits and back > first and sum(n[back - 1:i]) <= history and used + n[back - 1] <= budget:
                back -= 1
                used += n[back]
            shown += [(p, 1) for p in range(back, i)] + [(i, 2)]
            i += 1
            while fits and i < len(own) and used + n[i] <= budget:
                shown.append((i, 2))
                used += n[i]
                i += 1
            want[conv, window] = shown
            sizes[conv, window] = used
    found, tokens = {}, {}
    for r in chat.placed_turns(table, budget, history, 7, block).collect():
        found.setdefault((r["conv_id"], r["window"]), []).append((r["place"], r["kind"]))
        tokens.setdefault((r["conv_id"], r["window"]), []).append(r["_n"])
    assert {w: sorted(x) for w, x in found.items()} == want
    assert all(sum(tokens[w]) == n for w, n in sizes.items())
    assert all(sum(x) <= budget or len(x) == 1 for x in tokens.values())
    assert any(k == 1 for x in found.values() for _, k in x) and any(sum(x) > budget for x in tokens.values())


def test_pipeline_runs(spark, docs, tmp_path):
    import corpus_pipeline

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "source", "ids", "n_tokens"] and out.count() > 0
