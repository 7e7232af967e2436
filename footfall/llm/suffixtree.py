"""Substring dedup: prefix-partitioned suffix trees over words.

``repeats`` finds the places where a window of ``length`` words may occur twice.  Their pieces of
text are dealt out by anchor, and a task cuts them into suffixes of one window.  The suffixes of an
anchor with more than ``SUFFIXES`` are dealt out one by one, by prefixes of variable length: a prefix of
4 words first, 8, 12 or 16 where more than ``SUFFIXES`` suffixes share it, the whole window at last.
So a group fits into memory whatever the texts.  The suffix tree of some groups is held as their sorted
suffixes and the common prefix of each with the one before: an internal node is an interval of
them.  The topmost nodes at least ``length`` deep are the repeated windows; the smallest
position below such a node is the first occurrence, which stays (or not, without
``first_stays``).  Suffixes that share a whole window and are still too many for a group are
aggregated by that window, combined before the shuffle, without a tree.

A word is 32 bits of its hash in a suffix, with 64 bits of the window's hash behind it.

Defined results: null text has no words; texts shorter than ``length`` words lose nothing;
words keep their characters; rows with one id and text are one document for "earlier".
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_bytes, text_of, written
from .hyperminhash import _M3, mix64
from .repeats import STARTS, Symbols, cut_out, merged, repeated_ranges, starts_batch, whole_groups, with_ranges

LENGTH, GRAM = 20, 8
PREFIXES, SUFFIXES = (4, 8, 12, 16), 20_000
#: Pieces whose suffixes are in a tree at once.
PIECES = 1 << 13


def cut_suffixes(pieces: list[bytes], n: np.ndarray, kind: Symbols) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of the ``n`` window starts of each piece: their numbers in the piece, their suffixes cut to one window (a row
    of bytes each, 4 a word and 8 for the window's hash), and hashes of the prefixes and of the window."""
    h = kind.hashes(b" ".join(pieces).split(b" "))
    i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    sizes = n + (kind.length - 1)
    at = np.repeat(np.cumsum(sizes) - sizes, n) + i
    ends = [min(q, kind.length) for q in PREFIXES] + [kind.length]
    running, hashes = np.zeros(len(at), np.uint64), {}
    for k in range(kind.length):
        running = mix64(running * _M3 + h[at + k] + np.uint64(k + 1))
        if k + 1 in ends:
            hashes[k + 1] = running
    table = np.empty((len(at), 4 * kind.length + 8), np.uint8)
    words = (h >> np.uint64(32)).astype(">u4").view(np.uint8).reshape(-1, 4)
    for k in range(kind.length):
        table[:, 4 * k:4 * k + 4] = words[at + k]
    table[:, 4 * kind.length:] = running.astype(">u8").view(np.uint8).reshape(-1, 8)
    return i, table, [hashes[e].view(np.int64) for e in ends]


def suffixes(pieces: DataFrame, kind: Symbols) -> DataFrame:
    """One row per window start of a piece: its place, prefix hashes and cut suffix."""
    names = ["anchor", "variant", "i", "id", "tk", "at", *(f"p{q}" for q in PREFIXES), "window", "suffix"]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            n = b["n"].to_numpy()
            i, table, hashes = cut_suffixes(b["piece"].to_pylist(), n, kind)
            anchor, variant, doc, tk, lo = (np.repeat(b[c].to_numpy(), n) for c in ("anchor", "variant", "id", "tk", "lo"))
            width = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
            cut = pa.Array.from_buffers(pa.binary(), len(table), [None, pa.py_buffer(width), pa.py_buffer(table.tobytes())])
            columns = [anchor, variant, i.astype(np.int32), doc, tk, lo + i, *hashes]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), cut], names)

    return pieces.mapInArrow(run, "anchor long, variant long, i int, id long, tk long, at long, "
                             + ", ".join(f"p{q} long" for q in PREFIXES) + ", window long, suffix binary")


def common_prefixes(sorted_suffixes: np.ndarray, words: int) -> np.ndarray:
    """Words that each suffix shares with the one before (``words`` only if all of it is equal).

    ``sorted_suffixes``: a matrix of bytes, 4 a word and 8 for the window's hash.
    """
    differs = sorted_suffixes[1:] != sorted_suffixes[:-1]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), sorted_suffixes.shape[1])
    lcp = np.minimum(first // 4, words)
    lcp[(lcp == words) & (first < sorted_suffixes.shape[1])] = words - 1
    return np.r_[0, lcp]


def deep_nodes(lcp: np.ndarray, depth: int) -> np.ndarray:
    """Number of the topmost internal node at least ``depth`` deep above each leaf (leaves of
    no such node have numbers of their own)."""
    return np.cumsum(np.r_[0, lcp[1:] < depth])


def repeats_below(table: np.ndarray, place: tuple[np.ndarray, ...], words: int, first_stays: bool) -> np.ndarray:
    """Which suffixes (rows of ``table``, at ``id, tk, at``) start a window that occurs elsewhere (earlier, if the first
    stays).  Equal windows have one anchor and one prefix, so a table may hold several of these."""
    order = np.argsort(np.ascontiguousarray(table).view(f"S{table.shape[1]}").ravel(), kind="stable")
    # numpy's byte strings end at trailing zeros, which moves no window out of its run
    node = deep_nodes(common_prefixes(table[order], words), words)
    by_place = np.lexsort(place[::-1])
    rank = np.empty(len(table), np.int64)
    rank[by_place] = np.cumsum(np.r_[0, np.any([np.diff(p[by_place]) != 0 for p in place], axis=0)])
    found = np.zeros(len(table), bool)
    edges = np.flatnonzero(np.r_[True, np.diff(node) != 0])
    if first_stays:
        found[order] = rank[order] > np.minimum.reduceat(rank[order], edges)[node]
    else:
        found[order] = np.bincount(node)[node] > 1
    return found


def _trees(pieces: DataFrame, kind: Symbols, first_stays: bool) -> DataFrame:
    """``anchor, variant, starts``, from a tree of all suffixes of the pieces of some whole anchors."""
    def run(batches):
        for t in whole_groups(batches, "anchor", PIECES):
            anchor, variant, n, doc, tk, lo = (t[c].to_numpy() for c in ("anchor", "variant", "n", "id", "tk", "lo"))
            i, table, _ = cut_suffixes(t["piece"].to_pylist(), n, kind)
            place = (np.repeat(doc, n), np.repeat(tk, n), np.repeat(lo, n) + i)
            yield starts_batch(anchor, variant, n, repeats_below(table, place, kind.length, first_stays))

    return pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, STARTS)


def _subtrees(rows: DataFrame, kind: Symbols, first_stays: bool) -> DataFrame:
    """``anchor, variant, i`` of repeated windows, from a tree of all suffixes of some whole ``key``s."""
    def run(batches):
        for t in whole_groups(batches, "key", SUFFIXES):
            table = np.frombuffer(b"".join(t["suffix"].to_pylist()), np.uint8).reshape(t.num_rows, -1)
            found = repeats_below(table, tuple(t[c].to_numpy() for c in ("id", "tk", "at")), kind.length, first_stays)
            yield from t.select(["anchor", "variant", "i"]).filter(pa.array(found)).to_batches()

    return (rows.select("key", "anchor", "variant", "i", "id", "tk", "at", "suffix").repartition("key")
            .sortWithinPartitions("key").mapInArrow(run, "anchor long, variant long, i int"))


def _by_window(rows: DataFrame, first_stays: bool) -> DataFrame:
    place = F.struct("id", "tk", "at")
    groups = (rows.groupBy(F.col("key").alias("_w")).agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("first"))
              .where("c > 1"))
    hits = rows.join(groups, F.col("key") == F.col("_w"))
    return (hits.where(place > F.col("first")) if first_stays else hits).select("anchor", "variant", "i")


def match(pieces: DataFrame, kind: Symbols, first_stays: bool) -> DataFrame:
    """``anchor, variant, starts`` (see ``repeats.repeated_ranges``)."""
    crowded = written(pieces.groupBy("anchor").agg(F.sum("n").alias("c")).where(F.col("c") > SUFFIXES).select("anchor"),
                      "crowded-anchors")
    small = _trees(pieces.join(crowded, "anchor", "left_anti"), kind, first_stays)
    if crowded.isEmpty():
        return small
    return small.unionByName(by_prefixes(pieces.join(crowded, "anchor", "left_semi"), kind, first_stays))


def by_prefixes(pieces: DataFrame, kind: Symbols, first_stays: bool) -> DataFrame:
    """The same answer for anchors with more suffixes than a tree should hold."""
    left, hits = written(suffixes(pieces, kind), "suffixes"), None
    for q in PREFIXES:
        counts = left.groupBy(F.col(f"p{q}").alias("key")).agg(F.count(F.lit(1)).alias("c"))
        crowded = written(counts.where(F.col("c") > SUFFIXES).select("key"), "prefixes")
        own = left.withColumn("key", F.col(f"p{q}"))
        own = own.join(crowded, "key", "left_anti")
        found = _subtrees(own, kind, first_stays)
        hits = found if hits is None else hits.unionByName(found)
        if crowded.isEmpty():
            break
        left = left.join(crowded.withColumnRenamed("key", f"p{q}"), f"p{q}", "left_semi")
    else:
        hits = hits.unionByName(_by_window(left.withColumn("key", F.col("window")), first_stays))
    island = F.col("i") - F.row_number().over(Window.partitionBy("anchor", "variant").orderBy("i"))
    return (hits.withColumn("island", island).groupBy("anchor", "variant", "island")
            .agg(F.struct(F.min("i").alias("from"), (F.max("i") + 1).alias("until")).alias("s"))
            .groupBy("anchor", "variant").agg(F.collect_list("s").alias("starts")))


def repeated_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, first_stays: bool = True) -> DataFrame:
    return repeated_ranges(docs, Symbols(True, length, gram), match, first_stays)


def dedup_digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, first_stays: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per row."""
    rows = with_ranges(docs.select("doc_id", text_of().alias("text")),
                       repeated_words(docs, length, gram, first_stays)).select("doc_id", "text", "_ranges")

    def run(batches):
        for b in batches:
            n, removed, digest = [], [], []
            for text, ranges in zip(text_bytes(b.column(1)), b.column(2).to_pylist()):
                words, gone = text.split(), merged(ranges)
                n.append(len(words))
                removed.append(sum(e - s for s, e in gone))
                digest.append(hashlib.sha256(b" ".join(cut_out(words, gone))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string")
