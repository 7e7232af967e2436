"""Queries without SQL, on the whole smallest tables, against plain Python."""

import hashlib
import os
import re
import zlib

import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}


def run(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_tokens(spark, texts, ids):
    start = 0
    found = {r["doc_id"]: r for r in run(spark, "op1_token_blocks")}
    for i in sorted(texts):
        whole = [*ids[i], 0]
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in whole))
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (start, len(whole), crc)
        start += len(whole)
    for r in run(spark, "op7_bpe"):
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids[r["doc_id"]])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    for r in run(spark, "op12_tokenizer_alignment"):
        t = texts[r["doc_id"]]
        assert (r["n_a"] > 0) == (r["n_b"] > 0) == (r["groups_sha256"] != "") and (t or not r["n_a"])
        assert r["n_best"] <= r["n_links"] == r["n_groups"] <= min(r["n_a"], r["n_b"])


def test_mix_reruns_agree(spark, texts):
    one, two = ({r["doc_id"]: tuple(r) for r in run(spark, "op2_mix_sources")} for _ in range(2))
    assert one == two and one.keys() == texts.keys()
    assert all(r[1] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[i])) for i, r in one.items())


def test_edited_texts(spark, texts):
    order = sorted(texts, reverse=True)
    following = dict(zip(order, [*order[1:], order[0]]))
    found = {r["doc_id"]: r for r in run(spark, "op3_fingerprints")}
    for i, t in texts.items():
        n = len(t) // 3
        edited = t[:len(t) - n] + texts[following[i]][:n]
        assert (found[i]["n_chars"], found[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert found[i]["near_edited"] == 1 or t != edited
        assert (found[i]["fingerprint"] == found[following[i]]["fingerprint"]) == (t == texts[following[i]])


def test_quality(spark, texts):
    for r in run(spark, "op8_quality_rules"):
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"]) == (len(w), sum(map(len, w))) and not (r["base_failed"] and r["kept"])
    for r in run(spark, "op9_quality_classifier"):
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_chat(spark):
    turns = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    found = {r["conv_id"]: r for r in run(spark, "op10_chat_windows")}
    assert found.keys() == turns.keys()
    for c, x in turns.items():
        loss = "".join(t for role, t in x if role == "assistant")
        assert found[c]["n_turns"] == len(x) and found[c]["loss_chars"] == len(loss)
        assert found[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in x).encode()).hexdigest()
        assert found[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
