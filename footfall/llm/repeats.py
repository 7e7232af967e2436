"""Windows of a fixed length that occur more than once, over all documents.

Shared by the suffix-array and the suffix-tree operators.  A text is a sequence of symbols
(bytes or words); a window is ``length`` consecutive symbols of one document.

Every window contains an *anchor*: of its ``gram``-symbol grams the one with the smallest hash
(the rightmost of equals).  Equal windows have equal anchors at equal places.  Consecutive
windows with the same anchor form a *segment*; a text has about one segment per half window.

1. Anchors are counted; segments whose anchor occurs once hold no repeated window and go.
2. Segments equal in text and place of the anchor are one *variant*: its number and its first
   occurrence are known without moving any text, however many copies there are.
3. Only anchors with two variants or more need texts: one piece of text per variant goes to a
   matcher, which says which windows of a variant occur in another one too, and which of them
   earlier.
4. Occurrences are joined with their variant's answer; a document's repeated windows become
   ranges of symbols, and the ranges are cut out of the text.

Positions are ordered by ``doc_id`` (null first), then, for rows that share an id, by a hash
of their text, then by place.  Rows equal in both are one document for "earlier", and each
other's copies for "anywhere else".
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, text_bytes, text_of, written
from .hyperminhash import NO_ID, mix64

STARTS_AT_ONCE = 1 << 20
#: Bits for a place in such a part; the same for every part, so that equal windows of long and short
#: texts compare the same bits of their hashes.
PLACE_BITS = np.uint64(22)
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
SEGMENT = "anchor long, variant long, id long, tk long, lo long, place int, n int"
#: Segments sent from a task at once.
SEGMENTS_AT_ONCE = 1 << 14
STARTS = "anchor long, variant long, starts array<struct<from: int, until: int>>"
STARTS_SCHEMA = pa.schema([("anchor", pa.int64()), ("variant", pa.int64()), ("starts", pa.list_(pa.struct(
    [("from", pa.int32()), ("until", pa.int32())])))])


@dataclass(frozen=True)
class Symbols:
    """How a text is cut into symbols, and the lengths of windows and of grams."""

    words: bool
    length: int
    gram: int  # a power of two, below ``length``

    def split(self, text: bytes) -> bytes | list[bytes]:
        return text.split() if self.words else text

    def hashes(self, symbols: bytes | list[bytes]) -> np.ndarray:
        if self.words:
            return np.fromiter(map(xxhash.xxh64_intdigest, symbols), np.uint64, len(symbols))
        return _TABLE[np.frombuffer(symbols, np.uint8)]


def gram_hashes(h: np.ndarray, gram: int) -> np.ndarray:
    size = 1
    while size < gram:
        h = h[:-size] * _MULTIPLIER + (h[size:] ^ h[size:] >> np.uint64(29))
        size *= 2
    return mix64(h)


def window_minima(g: np.ndarray, width: int) -> np.ndarray:
    """Place of the rightmost smallest (by its upper bits) of each ``width`` consecutive values.

    The lower bits hold the distance from the end, so that one minimum carries value and place.
    """
    n = len(g)
    bits = PLACE_BITS
    low = (np.uint64(1) << bits) - np.uint64(1)
    value, size = g >> bits << bits | np.arange(n, 0, -1, dtype=np.uint64), 1
    while 2 * size <= width:
        value = np.minimum(value[:-size], value[size:])
        size *= 2
    if size < width:
        value = np.minimum(value[:size - width], value[width - size:])
    return n - (value & low).astype(np.int64)


def segments(h: np.ndarray, symbols: bytes | list[bytes], kind: Symbols) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchor, variant, lo, place, n`` of a text's segments: ``n`` windows from ``lo`` on,
    with the anchor ``place`` symbols after ``lo``.  Works through long texts in parts."""
    last = len(h) - kind.length
    for at in range(0, last + 1, STARTS_AT_ONCE):
        until = min(at + STARTS_AT_ONCE - 1, last)
        part = h[at:until + kind.length]
        grams = gram_hashes(part, kind.gram)
        anchors = window_minima(grams, kind.length - kind.gram + 1)
        lo = np.flatnonzero(np.r_[True, np.diff(anchors) != 0])
        n = np.diff(np.r_[lo, len(anchors)])
        place = anchors[lo] - lo
        source = part.tobytes() if kind.words else symbols[at:until + kind.length]
        step = 8 if kind.words else 1
        digest = xxhash.xxh64_intdigest
        variant = np.fromiter((digest(source[step * a:step * (a + m + kind.length - 1)], p) for a, m, p in zip(
            lo.tolist(), n.tolist(), place.tolist())), np.uint64, len(lo))
        yield grams[anchors[lo]].view(np.int64), variant.view(np.int64), lo + at, place, n


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, text, and the key ``id, tk`` of a row (null id: ``NO_ID``; null text: empty)."""
    return docs.select("doc_id", text_of().alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(text_of()).alias("tk"))


def all_segments(docs: DataFrame, kind: Symbols) -> DataFrame:
    names = [c.split()[0] for c in SEGMENT.split(", ")]
    types = (np.int64, np.int64, np.int64, np.int64, np.int64, np.int32, np.int32)

    def run(batches):
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(t, copy=False)) for c, t in zip(zip(*held), types)], names)

        for b in batches:
            for doc, tk, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2))):
                if len(text) < kind.length:
                    continue
                symbols = kind.split(text)
                if len(symbols) < kind.length:
                    continue
                for anchor, variant, lo, place, n in segments(kind.hashes(symbols), symbols, kind):
                    m = len(anchor)
                    held.append((anchor, variant, np.full(m, doc), np.full(m, tk), lo, place, n))
                    size += m
                    if size >= SEGMENTS_AT_ONCE:
                        yield rows()
                        held, size = [], 0
        if held:
            yield rows()

    return keyed(docs).select("id", "tk", "text").mapInArrow(run, SEGMENT)


def pieces(variants: DataFrame, docs: DataFrame, kind: Symbols) -> DataFrame:
    """``variants`` with ``piece``: the symbols of their first occurrence (words joined by a space)."""
    wanted = variants.groupBy("id", "tk").agg(F.sort_array(F.collect_list(F.struct(
        "lo", "anchor", "variant", "n", "place"))).alias("wanted"))
    # Rows equal in id and text have the same pieces: one of them gives each once.
    texts = keyed(docs).select("id", "tk", "text").join(wanted, ["id", "tk"]).dropDuplicates(["id", "tk"])
    names = [c.split()[0] for c in SEGMENT.split(", ")] + ["piece"]

    def run(batches):
        for b in batches:
            wants = b.column(3)
            counts, flat = pc.list_value_length(wants).to_numpy(), wants.flatten()
            of_want = dict(zip((f.name for f in flat.type), flat.flatten()))
            lo, n = of_want["lo"].to_pylist(), of_want["n"].to_pylist()
            cuts, at = [], 0
            for text, count in zip(text_bytes(b.column(2)), counts.tolist()):
                symbols = kind.split(text)
                for i in range(at, at + count):
                    cut = symbols[lo[i]:lo[i] + n[i] + kind.length - 1]
                    cuts.append(b" ".join(cut) if kind.words else cut)
                at += count
            row = np.repeat(np.arange(len(counts)), counts)
            columns = of_want | {"id": b.column(0).take(pa.array(row)), "tk": b.column(1).take(pa.array(row)),
                                 "piece": pa.array(cuts, pa.binary())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return texts.select("id", "tk", "text", "wanted").mapInArrow(run, SEGMENT + ", piece binary")


def repeated_ranges(docs: DataFrame, kind: Symbols, matcher: Callable[[DataFrame, Symbols, bool], DataFrame],
                    first_stays: bool) -> DataFrame:
    """``id, tk, ranges`` for documents with repeated windows: ranges ``from, until`` of symbols.

    ``matcher(pieces, kind, first_stays)`` returns ``anchor, variant, starts`` (ranges of
    window numbers of a variant that occur in another variant, or, with ``first_stays``, that
    occur in another variant earlier).
    """
    whole = written(all_segments(docs, kind), "all-segments")
    counted = whole.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"))
    repeated = counted.where("c > 1").select("anchor")
    found = written(whole.join(repeated, "anchor", "left_semi"), "segments")
    drop_written(whole)
    variants = written(
        found.groupBy("anchor", "variant").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "tk", "lo")).alias("first"),
            F.min("place").alias("place"), F.min("n").alias("n"))
        .select("anchor", "variant", "copies", "first.*", "place", "n"), "variants")
    several = variants.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
    texts = written(pieces(variants.join(several, "anchor").drop("copies", "variants"), docs, kind), "pieces")
    matched = matcher(texts, kind, first_stays)
    every = F.array(F.struct(F.lit(0).alias("from"), F.col("n").alias("until")))
    none = F.array().cast("array<struct<from: int, until: int>>")
    answers = variants.join(matched, ["anchor", "variant"], "left").withColumn("starts", F.coalesce("starts", none))
    if first_stays:
        answers = answers.select("anchor", "variant", F.struct("id", "tk", "lo").alias("first"), "starts",
                                 "n", "copies").where("copies > 1 or size(starts) > 0")
        starts = F.when(F.struct("id", "tk", "lo") == F.col("first"), F.col("starts")).otherwise(every)
        occurrences = found.drop("n", "place").join(answers, ["anchor", "variant"])
    else:
        answers = answers.select("anchor", "variant", F.when(F.col("copies") > 1, every).otherwise(F.col("starts"))
                                 .alias("starts")).where("size(starts) > 0")
        starts = F.col("starts")
        occurrences = found.drop("n", "place").join(answers, ["anchor", "variant"])
    ranges = occurrences.select("id", "tk", "lo", F.explode(starts).alias("s"))
    # Rows equal in id and text share the key and have the same ranges: a set holds them once.
    return ranges.groupBy("id", "tk").agg(F.collect_set(F.struct(
        (F.col("lo") + F.col("s.from")).alias("from"),
        (F.col("lo") + F.col("s.until") + (kind.length - 1)).alias("until"))).alias("ranges"))


def merged(ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Ranges in order, overlapping or touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["from"], r["until"]) for r in ranges or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_out(symbols: bytes | list[bytes], ranges: list[tuple[int, int]]):
    """The symbols outside ``ranges``."""
    kept, at = [], 0
    for a, b in ranges:
        kept.append(symbols[at:a])
        at = b
    kept.append(symbols[at:])
    return b"".join(kept) if isinstance(symbols, bytes) else [s for part in kept for s in part]


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """The columns of ``docs`` and ``_ranges`` (null: nothing is repeated)."""
    keys = {"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_tk": F.xxhash64(text_of())}
    found = ranges.select(F.col("id").alias("_id"), F.col("tk").alias("_tk"), F.col("ranges").alias("_ranges"))
    return docs.withColumns(keys).join(found, ["_id", "_tk"], "left").drop("_id", "_tk")


def whole_groups(batches: Iterator[pa.RecordBatch], column: str, rows: int) -> Iterator[pa.Table]:
    """The rows of ``batches``, about ``rows`` at a time, without parting those that follow one another with
    one value in ``column``."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        value = table[column].to_numpy()
        others = np.flatnonzero(value != value[-1])
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        size = table.num_rows - cut
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def starts_batch(anchor: np.ndarray, variant: np.ndarray, n: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
    """``anchor, variant, starts`` of pieces with ``n`` windows each; ``found`` has a flag for every window."""
    piece = np.repeat(np.arange(len(n)), n)
    number = np.arange(len(found)) - np.repeat(np.cumsum(n) - n, n)
    follows = np.zeros(len(found), bool)
    follows[1:] = found[1:] & found[:-1] & (piece[1:] == piece[:-1])
    begins = np.flatnonzero(found & ~follows)
    ends = np.flatnonzero(found & ~np.append(follows[1:], False))
    count = np.bincount(piece[begins], minlength=len(n))
    some = np.flatnonzero(count)
    offsets = np.r_[0, np.cumsum(count[some])].astype(np.int32)
    ranges = pa.StructArray.from_arrays([pa.array(number[begins], pa.int32()), pa.array(number[ends] + 1, pa.int32())],
                                        fields=list(STARTS_SCHEMA.field("starts").type.value_type))
    return pa.RecordBatch.from_arrays([pa.array(anchor[some]), pa.array(variant[some]),
                                       pa.ListArray.from_arrays(offsets, ranges, STARTS_SCHEMA.field("starts").type)],
                                      schema=STARTS_SCHEMA)
