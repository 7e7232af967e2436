"""Weights of hashed n-grams (words and pairs of neighbouring words), exchanged as packed arrays.

A row per n-gram in a shuffle takes about 13 bytes, which is 2.7 times the (compressed) input for
the counts alone and more for the way back.  Here texts are put into blocks; a block's n-grams are
counted in numpy, and what is shuffled is one row per block and range of hashes: sorted hashes as
differences, and counts, in byte planes compressed by zstd (about 4 bytes per n-gram of a block).  A task
adds up one range and returns to each block the weights of its n-grams, in the order it sent them.  Blocks
then meet their weights and add them up per text.

An n-gram is at most one entry per block, so a frequent one is no hot key, and ranges of a hash are
equally large.  Ranges are as many as the text has ``RANGE_BYTES``: memory of a task does not grow with the
corpus.  The counts are made in ``PASSES`` parts of the hash values, one after another, so that the shuffle of one
part is all that lies on disk; texts meet their weights twice, after each half of the parts.  Nothing is left out.

Hashes have ``HASH_BITS`` bits: of n distinct n-grams about n**2 / 2**53 meet another one.

Defined results: a text without words (null, empty) has no row; rows with equal keys have a row each;
a text longer than a block is a block of its own, in memory of about 20 times its length, and a word of any
length is hashed whole; columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import math
import posixpath
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sinks import scratch_table_path
from .common import drop_written, shuffle_partitions, shuffles_deleted, text_bytes, written

BLOCK_BYTES = 16 << 20
RANGE_BYTES = 8 << 20
PASSES = 4
HASH_BITS = 52
#: Bytes of texts whose n-grams are made at once; slices of hashes whose weights are looked up at once.
CHUNK, SLICES = 1 << 20, 8
#: Bytes hashed at once; longer words take another hash.
PIECE = 1 << 18
TARGET, CALIBRATES = 1, 2
#: Number of the range that stands for the sums of earlier ranges.
EARLIER = -1

_BLOCK = "block long, size long, k1 binary, k2 binary, flags binary, ends binary, text binary"
_COUNTS = "block long, part int, n int, grams binary, raw binary, good binary"
_WEIGHTS = "block long, part int, n int, weights binary, distinct long, raw long, good long"
_SENT = "block long, part int, n int, weights binary"
_SUMS = "_k1 long, _k2 long, flags int, _s double, _n long"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


# ------------------------------------------------------------------ hashes of a block's words
@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse."""
    base = 0x9E3779B97F4A7C15
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(PIECE + 1, b, np.uint64)
        p[0] = 1
        both.append(np.cumprod(p))
    return both[0], both[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``buf[start:end]``: differences of running polynomial sums."""
    power, inverse = _powers()
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        lo = starts[i]
        j = int(np.searchsorted(ends, lo + PIECE, "right"))
        if j <= i:
            out[i] = int.from_bytes(hashlib.blake2b(buf[lo:ends[i]].tobytes(), digest_size=8).digest(), "little")
            i += 1
            continue
        span = buf[lo:ends[j - 1]].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(span) + 1, np.uint64)
        np.cumsum(span * power[:len(span)], out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[b] - sums[a]) * inverse[a]
        i = j
    return _mixed(out)


def _text_ngrams(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of the texts that end at ``ends`` (each with one white-space byte after it), of each word with
    the next of its text (or none), and the text of each word."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = (buf != 0x20) & ((buf < 0x09) | (buf > 0x0D))
    edges = np.flatnonzero(np.diff(inside))
    starts, stops = edges[::2], edges[1::2]
    doc = np.searchsorted(ends, starts, "right")
    h = word_hashes(buf, starts, stops)
    following = np.zeros_like(h)
    following[:-1] = np.where(doc[1:] == doc[:-1], h[1:], np.uint64(0))
    pairs = _mixed(h * np.uint64(0xD6E8FEB86659FD93) + following * np.uint64(0xA0761D6478BD642F) + np.uint64(1))
    return h >> np.uint64(64 - HASH_BITS), pairs >> np.uint64(64 - HASH_BITS), doc


def chunk_ngrams(text: bytes, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``_text_ngrams`` of a block, some whole texts of about ``CHUNK`` bytes at a time: intermediate arrays take many
    times the bytes they are made from."""
    buf, first, at = np.frombuffer(text, np.uint8), 0, 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, at + CHUNK, "right")))
        words, pairs, doc = _text_ngrams(buf[at:ends[last - 1]], ends[first:last] - at)
        yield words, pairs, doc + first
        first, at = last, int(ends[last - 1])


def block_ngrams(text: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block's n-grams, first all words, then all pairs, and the text of each word."""
    words, pairs, doc = zip(*chunk_ngrams(text, ends))
    return np.concatenate((*words, *pairs)), np.concatenate(doc)


def chosen_ngrams(text: bytes, ends: np.ndarray, good: np.ndarray, least: int, until: int) -> tuple[np.ndarray, np.ndarray]:
    """Twice the hash, plus ``good`` of its text (0 or 1), of a block's n-grams with hashes from ``least`` on below
    ``until``, once each in order, and their counts."""
    held = []
    for words, pairs, doc in chunk_ngrams(text, ends):
        for grams in (words, pairs):
            chosen = (grams >= np.uint64(least)) & (grams < np.uint64(until))
            held.append(grams[chosen] << np.uint64(1) | good[doc[chosen]])
    return np.unique(np.concatenate(held), return_counts=True)


def gram_weights(grams: np.ndarray, weight: np.ndarray, least: int, until: int) -> np.ndarray:
    """The weight of each n-gram with a hash from ``least`` on below ``until`` (others: 0), from those of the distinct ones
    in order; a slice of the hashes at a time."""
    out, known = np.zeros(len(grams), weight.dtype), 0
    for i in range(SLICES):
        lo, hi = (np.uint64(least + (until - least) * k // SLICES) for k in (i, i + 1))
        at = np.flatnonzero((grams >= lo) & (grams < hi))
        found, place = np.unique(grams[at], return_inverse=True)
        out[at] = weight[known + place]
        known += len(found)
    return out


# ------------------------------------------------------------------ packing
def pack(values: np.ndarray) -> bytes:
    """The bytes of ``values``, all first bytes, then all second bytes and so on, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Texts of ``docs`` (``_k1``, ``_k2``, ``flags``, ``text``) in blocks of about ``block_bytes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, schema = TaskContext.get().partitionId(), 0, _schema(_BLOCK)
        codec = pa.Codec("zstd", compression_level=5)
        k1, k2, flags, texts, size = [], [], [], [], 0

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
            text = b"\n".join([*texts, b""])
            values = [(part << 32) + made, len(text), np.array(k1, np.int64).tobytes(), np.array(k2, np.int64).tobytes(),
                      bytes(flags), ends.tobytes(), codec.compress(text, asbytes=True)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            rows = zip(batch["_k1"].to_pylist(), batch["_k2"].to_pylist(), batch["flags"].to_pylist(), text_bytes(batch["text"]))
            for a, b, flag, text in rows:
                if texts and size + len(text) > block_bytes:
                    yield row()
                    k1, k2, flags, texts, size, made = [], [], [], [], 0, made + 1
                k1.append(a), k2.append(b), flags.append(flag), texts.append(text)
                size += len(text) + 1
        if texts:
            yield row()

    return docs.select("_k1", "_k2", "flags", "text").mapInArrow(run, _BLOCK)


def bucketed(table: DataFrame) -> tuple[DataFrame, str]:
    """``table`` written in buckets of ``block``, so that it need not be shuffled to meet its weights; and its name."""
    spark = table.sparkSession
    path = scratch_table_path(spark, "ngram-blocks")
    name = posixpath.basename(path).replace("-", "_")
    with shuffles_deleted(spark):
        (table.write.bucketBy(shuffle_partitions(spark), "block").option("path", path).option("compression", "none")
         .saveAsTable(name))
    return spark.table(name), name


def _text_of_block(size: int, text: bytes) -> bytes:
    return pa.decompress(text, size, codec="zstd", asbytes=True)


def block_counts(table: DataFrame, parts: int, only: range) -> DataFrame:
    """Per block and range of hashes (of ``parts``; those in ``only``): hashes, counts in all its texts and
    counts in texts of the target."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, schema = np.uint64(HASH_BITS - parts.bit_length() + 1), _schema(_COUNTS)
        for batch in batches:
            for i in range(batch.num_rows):
                block, size, flags, ends, text = (batch[c][i].as_py() for c in ("block", "size", "flags", "ends", "text"))
                good = (np.frombuffer(flags, np.uint8) & TARGET).astype(np.uint64)
                keyed, n = chosen_ngrams(_text_of_block(size, text), np.frombuffer(ends, np.int64), good,
                                         only.start << int(shift), only.stop << int(shift))
                grams = keyed >> np.uint64(1)
                if not len(grams):
                    continue
                first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
                raw = np.add.reduceat(n, first).astype(np.uint32)
                target = np.add.reduceat(n * (keyed & np.uint64(1)).astype(np.int64), first).astype(np.uint32)
                grams = grams[first]
                cuts = np.searchsorted(grams, np.arange(only.start, only.stop + 1, dtype=np.uint64) << shift)
                for p, lo, hi in zip(only, cuts[:-1], cuts[1:]):
                    if lo < hi:
                        steps = np.diff(grams[lo:hi], prepend=np.uint64(0))
                        values = [block, p, hi - lo, pack(steps), pack(raw[lo:hi]), pack(target[lo:hi])]
                        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return table.select("block", "size", "flags", "ends", "text").mapInArrow(run, _COUNTS)


def range_weights(counts: DataFrame) -> DataFrame:
    """Per row of ``counts`` the weights ``ln(good + 1) - ln(raw + 1)`` of its n-grams over all blocks; a range's first
    row brings its numbers of distinct n-grams, of all and of those of the target."""
    def run(table: pa.Table) -> pa.Table:
        sizes = table["n"].to_numpy()
        grams = np.concatenate([np.cumsum(unpack(x.as_py(), n, "<u8"), dtype=np.uint64) for x, n in zip(table["grams"], sizes)])
        found, at = np.unique(grams, return_inverse=True)
        raw, good = (np.bincount(at, np.concatenate([unpack(x.as_py(), n, "<u4") for x, n in zip(table[c], sizes)]))
                     for c in ("raw", "good"))
        weights = (np.log1p(good) - np.log1p(raw)).astype(np.float32)[at]
        zeros = [0] * (len(sizes) - 1)
        return pa.Table.from_arrays([
            table["block"], table["part"], table["n"],
            pa.array([pack(w) for w in np.split(weights, np.cumsum(sizes)[:-1])], pa.binary()),
            *(pa.array([int(x), *zeros], pa.int64()) for x in (len(found), raw.sum(), good.sum()))], schema=_schema(_WEIGHTS))

    return counts.groupBy("part").applyInArrow(run, _WEIGHTS)


def text_sums(table: DataFrame, weights: DataFrame, parts: int, only: range, last: bool) -> DataFrame:
    """Per text with a word: keys, flags, the sum of its n-grams' weights and their number.

    ``weights`` has the ranges ``only`` and, as range ``EARLIER``, what this function gave for those before; unless ``last``,
    the result is such a row per block."""
    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        schema = _schema(_SUMS if last else _SENT)
        if not block.num_rows or not found.num_rows:
            return schema.empty_table()
        size, k1, k2, flags, ends, text = (block[c][0].as_py() for c in ("size", "k1", "k2", "flags", "ends", "text"))
        part, weight, total = found["part"].to_numpy(), [np.empty(0, np.float32)], np.zeros(len(flags))
        for i in np.argsort(part).tolist():
            data, n = found["weights"][i].as_py(), found["n"][i].as_py()
            if part[i] == EARLIER:
                total += np.frombuffer(data, np.float64)
            else:
                weight.append(unpack(data, n, "<f4"))
        grams, doc = block_ngrams(_text_of_block(size, text), np.frombuffer(ends, np.int64))
        shift = HASH_BITS - parts.bit_length() + 1
        # Words first, then pairs: a text's weights are added in the order of its own words wherever it stands.
        each = gram_weights(grams, np.concatenate(weight), only.start << shift, only.stop << shift)
        word, pair = (np.bincount(doc, w.astype(np.float64), len(flags)) for w in (each[:len(doc)], each[len(doc):]))
        total += word + pair
        if not last:
            values = [block["block"][0].as_py(), EARLIER, len(flags), total.tobytes()]
            return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)
        n = np.bincount(doc, minlength=len(flags))
        some = np.flatnonzero(n)
        columns = (np.frombuffer(k1, np.int64), np.frombuffer(k2, np.int64), np.frombuffer(flags, np.uint8).astype(np.int32),
                   total, 2 * n)
        return pa.Table.from_arrays([pa.array(c[some], f.type) for c, f in zip(columns, schema)], schema=schema)

    # A block's weights are one group beside its text, which stays where its bucket is.
    sent = weights.repartition(shuffle_partitions(table.sparkSession), "block")
    return table.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(run, _SUMS if last else _SENT)


def log_ratio_sums(docs: DataFrame, block_bytes: int | None = None, range_bytes: int | None = None,
                   passes: int | None = None) -> tuple[DataFrame, float]:
    """``_k1, _k2, flags, _s, _n`` per text with a word, and a number: the sum of its n-grams' log-ratios of target to raw
    probability, each smoothed by one over the distinct n-grams, is ``_s`` plus ``_n`` times that number.

    ``docs`` has ``_k1``, ``_k2`` (long), ``flags`` (int: ``TARGET``, ``CALIBRATES``) and ``text``.
    """
    spark = docs.sparkSession
    table, name = bucketed(blocks(docs, block_bytes or BLOCK_BYTES))
    size = table.agg(F.sum("size")).first()[0]
    parts = 1 << max(0, math.ceil(math.log2(max(1, (size or 0) / (range_bytes or RANGE_BYTES)))))
    passes = min(parts, passes or PASSES)
    distinct = raw = good = 0
    sums, tables, since = None, [], 0
    for i in range(passes):
        only = range(parts * i // passes, parts * (i + 1) // passes)
        counts = block_counts(table, parts, only).repartition(max(len(only) // 8, min(len(only), shuffle_partitions(spark))), "part")
        tables.append(written(range_weights(counts), "ngram-weights"))
        n = tables[-1].agg(F.sum("distinct"), F.sum("raw"), F.sum("good")).first()
        distinct, raw, good = (a + (b or 0) for a, b in zip((distinct, raw, good), n))
        if i + 1 in (passes, (passes + 1) // 2):
            # Weights of half the ranges are all that lies on disk, twice while they are shuffled.
            sent = [t.select("block", "part", "n", "weights") for t in tables] + ([] if sums is None else [sums])
            earlier, sums = sums, written(text_sums(table, reduce(DataFrame.unionByName, sent), parts,
                                                    range(since, only.stop), i + 1 == passes), "ngram-sums")
            for t in (*tables, *([] if earlier is None else [earlier])):
                drop_written(t)
            tables, since = [], only.stop
    drop_written(table)
    spark.sql(f"DROP TABLE {name}")
    return sums, math.log(raw + distinct) - math.log(good + distinct) if distinct else 0.0
