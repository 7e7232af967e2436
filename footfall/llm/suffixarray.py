"""Suffix-array dedup: longest-previous-factor arrays.

``lpf`` sorts the suffixes of a text, takes the common prefixes of neighbours in that order,
and gives each position the longest prefix it shares with an earlier position: the better of
the nearest entries with a smaller position before and after it in suffix order.

Over a corpus (``repeats`` finds the candidates), the pieces of text around one anchor are
joined to one text, positions numbered by document and place, and a window of ``length`` bytes
occurs earlier iff its LPF value reaches ``length``.  With positions numbered backwards too
the same arrays give later matches, and the two together "anywhere else".

An anchor with more than ``VARIANTS`` variants (a line in very many different surroundings) is
not gathered in one task.  Equal windows have their anchor at one distance from the start, so its
variants are cut by ranges of distances, and a part is grouped by the bytes that every window of its
range covers: equal windows are in one group.  Of parts equal as a whole (by 64-bit hashes, with the
anchor and the group) one is left to stand for the others.  A group of more than ``VARIANTS`` parts is cut into
ranges a ``CUT``-th as wide, and so on; at one distance a group's parts are equal.  Others are settled by LPF.

Defined results: null text is empty; texts shorter than ``length`` lose nothing; repeated rows
are each other's copies; with ``first_stays`` the first place of each window stays whole.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import any_columns, drop_written, text_bytes, text_of, written
from .repeats import (STARTS, STARTS_SCHEMA, Symbols, cut_out, merged, repeated_ranges, starts_batch, whole_groups,
                      with_ranges)

LENGTH, GRAM, VARIANTS = 200, 32, 2048
#: Pieces (of less than 400 bytes) in a suffix array at once.
PIECES = 1 << 10
#: Parts a range of distances is cut into when its group is crowded.
CUT = 4
PART = ("anchor long, variant long, id long, tk long, lo long, place int, n int, first int, group long, whole long, "
        "piece binary")


def suffix_array(symbols: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``limit`` symbols (or more), and the common prefix of
    each with the one before, at most ``limit``.  Prefix doubling; a suffix's end sorts first."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    levels, size = [rank], 1
    while True:
        after = np.zeros(n, np.int64)
        after[:max(0, n - size)] = rank[size:]
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key)
        if 2 * size >= limit:
            break
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.r_[1, sorted_key[1:] != sorted_key[:-1]]) if n else []
        rank, size = new, 2 * size
        levels.append(rank)
    lcp, left, right = np.zeros(n, np.int64), order[:-1], order[1:]
    common = np.zeros(max(0, n - 1), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        padded = np.r_[levels[k], np.zeros(1, np.int64)]
        i, j = np.minimum(left + common, n), np.minimum(right + common, n)
        for _ in range(2 if k == len(levels) - 1 else 1):
            same = (padded[i] == padded[j]) & (padded[i] > 0)
            common += np.where(same, 1 << k, 0)
            i, j = np.minimum(left + common, n), np.minimum(right + common, n)
    lcp[1:] = np.minimum(common, limit)
    return order, lcp


def lpf(order: np.ndarray, lcp: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Per suffix-array entry: longest common prefix with any suffix of smaller ``position``.

    The nearest entries before and after with a smaller position have the longest ones.  They
    are found by descending over minima of blocks of doubling size; the smallest ``lcp`` on
    the way is the common prefix.
    """
    p, c = position[order], lcp
    before = _nearest_smaller(p, c)
    after = _nearest_smaller(p[::-1], np.r_[c[:1], c[1:][::-1]])[::-1]
    return np.maximum(before, after)


def _nearest_smaller(p: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Per entry, the smallest ``c`` on the way back to the nearest entry of smaller ``p`` (0: none)."""
    n, size = len(p), 1
    low, cost = [p.astype(np.int32)], [c.astype(np.int32)]  # of the 2**k entries up to an entry
    while 2 * size <= n:
        wider, dearer = low[-1].copy(), cost[-1].copy()
        wider[size:] = np.minimum(low[-1][size:], low[-1][:-size])
        dearer[size:] = np.minimum(cost[-1][size:], cost[-1][:-size])
        low.append(wider)
        cost.append(dearer)
        size *= 2
    at, value = np.arange(n) - 1, c.copy()
    for k in range(len(low) - 1, -1, -1):
        j = np.maximum(at, 0)
        skip = (at >= (1 << k) - 1) & (low[k][j] >= p)
        value = np.where(skip, np.minimum(value, cost[k][j]), value)
        at = np.where(skip, at - (1 << k), at)
    return np.where(at >= 0, value, 0)


def repeated_windows(rows: pa.Table, kind: Symbols, first_stays: bool) -> pa.RecordBatch:
    """Windows of each piece that occur in another piece of its anchor (earlier, if the first
    stays).  Pieces of several anchors share one suffix array: a symbol is a byte with the
    number of its anchor, and pieces end with symbols of their own."""
    anchor, variant, n, doc, tk, lo = (rows[c].to_numpy() for c in ("anchor", "variant", "n", "id", "tk", "lo"))
    pieces = rows["piece"].to_pylist()
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
    piece, ends = np.repeat(np.arange(len(pieces)), sizes), np.cumsum(sizes)
    place = np.arange(ends[-1]) - (ends - sizes)[piece]
    number = np.unique(anchor, return_inverse=True)[1]
    symbols = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8) + (number * 256 + len(pieces))[piece]
    symbols[ends - 1] = np.arange(len(pieces))
    order, lcp = suffix_array(symbols, kind.length)
    # Entries that share a window with a neighbour; an entry before each run of them shares less.
    shares = lcp >= kind.length
    at_run = np.flatnonzero(shares | np.append(shares[1:], False))
    order, lcp = order[at_run], lcp[at_run]
    position, of = np.empty(len(order), np.int64), piece[order]
    position[np.lexsort((lo[of] + place[order], tk[of], doc[of]))] = every = np.arange(len(order))
    repeated = np.zeros(len(symbols), bool)
    repeated[order] = lpf(every, lcp, position) >= kind.length
    if not first_stays:
        later = np.zeros(len(symbols), bool)
        later[order] = lpf(every, lcp, -position) >= kind.length
        repeated |= later
    return starts_batch(anchor, variant, n, repeated[place < n[piece]])


def parts(rows: DataFrame, kind: Symbols, width: int) -> DataFrame:
    """The pieces in ``rows``, cut by the distance of a window's anchor from its start: one row per range of
    ``width`` distances that holds windows of the piece.

    ``lo``, ``place``, ``n`` and ``piece`` are those of the windows in the range, ``first`` the number of the first
    in its variant.  ``group`` is a hash of the bytes that every window of the range covers, so equal windows are
    in one group; parts equal as a whole have one ``whole``."""
    names = [c.split()[0] for c in PART.split(", ")]
    types = (np.int64, np.int32, np.int32, np.int32)
    last, digest = kind.length - kind.gram, xxhash.xxh64_intdigest

    def run(batches):
        for b in batches:
            of, made, keys, cuts = [], [], [], []
            columns = zip(*(b[c].to_pylist() for c in ("lo", "place", "n", "first", "piece")))
            for row, (lo, place, n, first, piece) in enumerate(columns):
                for k in range((place - n + 1) // width, place // width + 1):
                    least, most = max(k * width, place - n + 1), min((k + 1) * width - 1, place)
                    at = place - most
                    cut = piece[at:place - least + kind.length]
                    core = piece[place - k * width:place + kind.length - min((k + 1) * width - 1, last)]
                    of.append(row)
                    made.append((lo + at, most, most - least + 1, first + at))
                    keys.append((digest(core, k), digest(cut, most)))
                    cuts.append(cut)
            kept = [b[c].take(pa.array(of, pa.int64())) for c in ("anchor", "variant", "id", "tk")]
            made = zip(*made) if made else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(np.array(c, t)) for c, t in zip(made, types)),
                 *(pa.array(np.array(c, np.uint64).view(np.int64)) for c in (zip(*keys) if keys else [()] * 2)),
                 pa.array(cuts, pa.binary())], names)

    return rows.mapInArrow(run, PART)


def part_starts(rows: pa.Table, kind: Symbols, first_stays: bool) -> pa.RecordBatch:
    """``repeated_windows`` of parts of variants, by ``group``; windows are numbered as in the variant."""
    found = repeated_windows(rows.drop_columns(["anchor", "variant"])
                             .append_column("anchor", rows["group"])
                             .append_column("variant", pa.array(np.arange(rows.num_rows))), kind, first_stays)
    at, starts = found["variant"], found["starts"]
    first = np.repeat(rows["first"].to_numpy()[at.to_numpy()], np.diff(starts.offsets.to_numpy()))
    ranges = pa.StructArray.from_arrays([pa.array(c.to_numpy() + first, pa.int32()) for c in starts.values.flatten()],
                                        fields=list(starts.type.value_type))
    anchor, variant = (rows[c].combine_chunks().take(at) for c in ("anchor", "variant"))
    return pa.RecordBatch.from_arrays([anchor, variant, pa.ListArray.from_arrays(starts.offsets, ranges, starts.type)],
                                      schema=STARTS_SCHEMA)


def crowded_starts(rows: DataFrame, kind: Symbols, first_stays: bool) -> DataFrame:
    """The same answer as ``repeated_windows`` for pieces of anchors with many variants, by parts."""
    key, names, place = ["anchor", "group"], rows.columns, F.struct("id", "tk", "lo")
    width, answers = 1, []
    while width * CUT < kind.length - kind.gram + 1:
        width *= CUT

    def run(batches):
        for table in whole_groups(batches, "group", PIECES):
            yield part_starts(table, kind, first_stays)

    rows = rows.withColumn("first", F.lit(0))
    while True:
        cut = written(parts(rows, kind, width), "crowded-parts")
        wholes = written(cut.groupBy(*key, "whole").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("earliest")),
                         "crowded-wholes")
        several = wholes.groupBy(*key).agg(F.count(F.lit(1)).alias("wholes"), F.max("copies").alias("most"))
        judged = wholes.join(several.where("wholes > 1 or most > 1").drop("most"), key)
        found = written(cut.join(judged, [*key, "whole"]).withColumn("stays", place == F.col("earliest")).drop("earliest"),
                        "crowded-found")
        drop_written(cut)
        drop_written(wholes)
        # Parts that others equal as a whole are settled; one of them stands for the others' windows.
        settled = found.where("copies > 1" if not first_stays else "not stays")
        answers.append(settled.select("anchor", "variant", F.col("first").alias("from"), (F.col("first") + F.col("n")).alias("until")))
        found = found.where("stays and wholes > 1")
        few = (found.where(F.col("wholes") <= VARIANTS).drop("wholes", "copies", "stays", "whole").repartition(*key)
               .sortWithinPartitions("group").mapInArrow(run, STARTS))
        answers.append(written(few, "crowded-starts").select("anchor", "variant", F.explode("starts").alias("s"))
                       .select("anchor", "variant", "s.*"))
        rows = found.where(F.col("wholes") > VARIANTS).select(*names, "first")
        if width == 1 or rows.isEmpty():
            break
        width //= CUT
    return (reduce(DataFrame.unionByName, answers).groupBy("anchor", "variant")
            .agg(F.collect_list(F.struct("from", "until")).alias("starts")))


def match(pieces: DataFrame, kind: Symbols, first_stays: bool) -> DataFrame:
    """``anchor, variant, starts`` (see ``repeats.repeated_ranges``)."""
    crowded = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > VARIANTS).select("anchor")
    crowded = written(crowded, "crowded-anchors")

    def run(batches):
        for rows in whole_groups(batches, "anchor", PIECES):
            yield repeated_windows(rows, kind, first_stays)

    small = (pieces.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
             .mapInArrow(run, STARTS))
    if crowded.isEmpty():
        return small
    return small.unionByName(crowded_starts(pieces.join(crowded, "anchor", "left_semi"), kind, first_stays))


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, first_stays: bool = True) -> DataFrame:
    return repeated_ranges(docs, Symbols(False, length, gram), match, first_stays)


def dedup_digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, first_stays: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row."""
    rows = with_ranges(docs.select("doc_id", text_of().alias("text")),
                       repeated_bytes(docs, length, gram, first_stays)).select("doc_id", "text", "_ranges")

    def run(batches):
        for b in batches:
            n, removed, spans, digest = [], [], [], []
            for text, ranges in zip(text_bytes(b.column(1)), b.column(2).to_pylist()):
                gone = merged(ranges)
                n.append(len(text))
                removed.append(sum(e - s for s, e in gone))
                spans.append(len(gone))
                digest.append(hashlib.sha256(cut_out(text, gone)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


@any_columns
def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, first_stays: bool = True) -> DataFrame:
    """``docs`` with repeated bytes cut out of ``text``; documents with nothing left go.

    A range that begins or ends inside a UTF-8 character keeps that character whole.
    """
    rows = with_ranges(docs, repeated_bytes(docs, length, gram, first_stays))
    names = docs.columns
    t = names.index("text")

    def run(batches):
        for b in batches:
            texts = [None if null else cut_out(x, whole_characters(x, merged(r))).decode()
                     for x, r, null in zip(text_bytes(b.column(t)), b.column(len(names)).to_pylist(),
                                           b.column(t).is_null().to_pylist())]
            columns = [pa.array(texts, b.column(t).type) if i == t else b.column(i) for i in range(len(names))]
            out = pa.RecordBatch.from_arrays(columns, names)
            lost = [r is not None and not x for x, r in zip(texts, b.column(len(names)).to_pylist())]
            yield out.filter(pa.array([not x for x in lost], pa.bool_()))

    return rows.select(*names, "_ranges").mapInArrow(run, docs.schema)


def whole_characters(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges shrunk to character boundaries."""
    out = []
    for a, b in ranges:
        while a < b and a < len(text) and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out
