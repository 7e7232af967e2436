"""The conversation trie against a dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pytest

pytest.importorskip("public_tokenizers")

from footfall.llm import trie  # noqa: E402
from footfall.llm.common import prepare  # noqa: E402

SCHEMA = "conv_id long, turn int, role string, text string, words string, key string, k int"


def md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain_paths(rows, shared):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", md5(role or "", text or ""), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in convs.items()}
    if not shared:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lead = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(lead, [])[:h] + turns[h:]
    return out


def plain_trie(paths):
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        kids = [below(x) for x in children.get(node, [])]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        return (sum(k[0] for k in kids) or 1, sum(k[1] for k in kids) + (len(members[node]) - 1) * words)

    out = []
    for node, convs in members.items():
        leaves, saved = below(node)
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    len(children.get(node, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                    r["saved_tokens"], r["ends_sha256"]) for r in df.collect()), key=str)


def rows_of(seed, n, longest, texts=("a b", "c", "d e f", "", None)):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(-3, n), 10 ** 6]:
        last = rnd.choice([0, 1, 2, 5, longest])
        for i in range(last + 1):
            rows.append((c, rnd.choice([i, i, i, None, 1]), rnd.choice(["user", "user", None, "x"]) if rnd.random() < .3 else "user",
                         rnd.choice(texts) if rnd.random() < .3 else "a b", "clash", "clash", 5))
    rows += [r for r in rows if r[0] == 7] + [(None, 0, "user", "nobody", "clash", "clash", 5)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment", [2, 512])
@pytest.mark.parametrize("shared", [True, False])
def test_trie(spark, monkeypatch, segment, shared):
    prepare(spark)
    monkeypatch.setattr(trie, "SEGMENT", segment)
    rows = rows_of(segment, 70, 9)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = trie.shared_trie(df) if shared else trie.trie(trie.own_paths(trie.numbered_turns(df)))
    assert found(got) == plain_trie(plain_paths(rows, shared))


def test_turnless_conversations_and_no_conversation(spark):
    prepare(spark)
    # crc32("30") % 4 > 0 and 20 is absent: conversations of one turn lose it and end at the root.
    rows = [(c, 0, "user", "a", "", "", 0) for c in (30, 31, 32, 33, 34, 35)]
    assert any(not p for p in plain_paths(rows, True).values())
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(trie.shared_trie(df)) == plain_trie(plain_paths(rows, True))
    assert trie.shared_trie(df.where("false")).count() == 0


def test_many_equal_conversations_in_small_ranges(spark):
    prepare(spark)
    rows = [(c, i, "user", f"turn {i}", "", "", 0) for c in range(400) for i in range(3)]
    rows += [(c, 3, "user", f"end {c % 3}", "", "", 0) for c in range(0, 400, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = trie.trie(trie.own_paths(trie.numbered_turns(df)))
    assert found(got) == plain_trie(plain_paths(rows, False))


def test_common_turns():
    a = "".join(f"{i:032d}" for i in range(9))
    for n in range(10):
        assert trie.common_turns(a, a[:32 * n]) == n
        assert trie.common_turns(a, a[:32 * n] + "x" * 32 * (9 - n)) == n
