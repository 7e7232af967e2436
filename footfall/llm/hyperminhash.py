"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct word shingles, as 64-bit hashes.  Each hash falls into one of
``K`` buckets; a bucket keeps the smallest remaining hash value, compressed to its number of
leading zeros and the ``MANTISSA`` bits after the first one: a 16-bit register (0: empty).
Bands of ``ROWS`` registers, as many as bring the chance of missing a link at the threshold
below ``MISS``, propose candidates; the share of equal registers, corrected for chance
collisions of compressed values, drops candidates ``SIGMAS`` standard deviations below the
threshold; full sets confirm the rest exactly.

Groups are never expanded into pairs.  Equal sets are one node (its id: 64 bits of a digest of
the set; equal for different sets with a chance of n**2 / 2**65).  Of bands with the same
members (by count and a 64-bit hash) only the first one is kept.  Round one tests a
node against the smallest node of each of its bands and merges what is confirmed.  Bands that
still hold more than one component are dealt out as pairs of blocks of about ``BLOCK`` members
or ``BLOCK_SHINGLES`` shingles: first, in crowded bands only, each block with itself and with the first one, whose
rows grow with the members; then, of what holds different components still, all pairs of blocks, but none of one
component's own blocks.  Each time, registers choose the members with a plausible partner of
another component in their blocks; those get their full sets, and each
plausible pair is tested once, where its first shared band is, unless links of the same blocks have joined
its ends already; returned are the links that joined something: fewer than there are members.

Defined results: null, empty or blank text has the empty set, size 0, and is linked with
nothing; rows with one ``doc_id`` and different texts are different nodes; a null ``doc_id``
takes part, its component is the smallest id reachable (null if there is none); equal rows get
equal results, except that ``keep_first`` keeps one of them.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import any_columns, drop_written, text_bytes, text_of, written
from .components import components
from .quality import row_keys
from .sieve import Sieve

ROWS, MANTISSA, MISS, SIGMAS = 6, 10, 1e-6, 5
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
KEY_BITS = 48
NO_ID = -(1 << 63)  # stands for a null doc_id
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float) -> int:
    """Bands whose chance of missing a pair at the threshold is below ``MISS``."""
    return math.ceil(math.log(MISS) / math.log(1 - threshold ** ROWS))


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _M1
    x = (x ^ x >> np.uint64(27)) * _M2
    return x ^ x >> np.uint64(31)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles (A-Z lower-cased)."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(width, len(words))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix64(out * _M3 + h[i:len(h) - n + 1 + i])
    return np.unique(out)


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def registers_of(shingles: np.ndarray, k: int) -> np.ndarray:
    """One 16-bit register per bucket: leading zeros + 1 above ``MANTISSA`` bits; 0 if empty."""
    value = mix64(shingles + _M3)
    least = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    bucket = (mix64(shingles ^ _M1) % np.uint64(k)).astype(np.int64)
    np.minimum.at(least, bucket, value)
    used = np.zeros(k, bool)
    used[bucket] = True
    zeros = 53 - np.frexp((least >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.minimum(zeros, 61)
    mantissa = least << (zeros + 1).astype(np.uint64) >> np.uint64(64 - MANTISSA)
    return np.where(used, (zeros + 1).astype(np.uint64) << np.uint64(MANTISSA) | mantissa, 0).astype(np.uint16)


def all_band_keys(registers: np.ndarray) -> np.ndarray:
    """Keys of each band, for a matrix of registers: the place of the band, then ``KEY_BITS`` bits of hash."""
    n, k = registers.shape
    bands = registers.reshape(n, k // ROWS, ROWS)
    place = np.broadcast_to(np.arange(1, k // ROWS + 1, dtype=np.uint64), bands.shape[:2])
    key = place.copy()
    for i in range(ROWS):
        key = mix64(key * _M3 + bands[:, :, i])
    return (place << np.uint64(KEY_BITS) | key >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def band_keys(registers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of the bands that hold any element, for a matrix of registers."""
    row, band = np.nonzero(registers.reshape(len(registers), registers.shape[1] // ROWS, ROWS).any(axis=2))
    return row, all_band_keys(registers)[row, band]


def cell_chances(sizes: np.ndarray, k: int) -> np.ndarray:
    """Per set size, the chance of each number of leading zeros in a register."""
    high = np.asarray(sizes, float)[..., None] / k * 2.0 ** -np.arange(62)
    return np.exp(-high / 2) - np.exp(-high)


def estimates(ra: np.ndarray, rb: np.ndarray, cells_a: np.ndarray, cells_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the similarity, corrected for the chance that registers of unrelated buckets
    are equal (both minima in one cell), and the number of buckets they rest on."""
    used = np.maximum((np.maximum(ra, rb) > 0).sum(axis=-1), 1)
    share = ((ra == rb) & (ra > 0)).sum(axis=-1) / used
    chance = (cells_a * cells_b).sum(axis=-1) / 2 ** MANTISSA
    return (share - chance) / (1 - chance), used


def plausible(ra: np.ndarray, rb: np.ndarray, cells_a: np.ndarray, cells_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the estimate is at most ``SIGMAS`` standard deviations below the threshold."""
    value, used = estimates(ra, rb, cells_a, cells_b)
    return value >= threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / used)


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, k)


def text_key() -> Column:
    """With the ``doc_id``, names a row's text."""
    return F.xxhash64(text_of())


def signatures(docs: DataFrame, width: int, k: int, keys: dict[str, Column]) -> DataFrame:
    """``doc_id, n_shingles, node, registers`` per row, and the given keys (64 bits each)."""
    names = list(keys)

    def run(batches):
        for b in batches:
            sets = [shingle_set(t, width) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([registers_of(s, k).tobytes() if len(s) else None for s in sets], pa.binary()),
                 *b.columns[2:]], ["doc_id", "n_shingles", "node", "registers", *names])

    return docs.select("doc_id", "text", *[c.alias(n) for n, c in keys.items()]).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, node long, registers binary"
        + "".join(f", {n} long" for n in names))


def _bands(nodes: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for b in batches:
            if len(b):
                row, key = band_keys(_matrix(b.column(1), k))
                yield pa.RecordBatch.from_arrays([pa.array(key), b.column(0).take(pa.array(row))], ["band", "node"])

    return nodes.select("node", "registers").mapInArrow(run, "band long, node long")


def _register_test(pairs: DataFrame, nodes: DataFrame, threshold: float, k: int) -> DataFrame:
    """The pairs ``a, b`` whose registers may stand for sets as similar as the threshold."""
    sides = [nodes.select(F.col("node").alias(c), F.col("registers").alias(f"r{c}"), F.col("n_shingles").alias(f"n{c}"))
             for c in "ab"]

    def run(batches):
        for x in batches:
            if len(x):
                ok = plausible(_matrix(x.column(2), k), _matrix(x.column(3), k),
                               cell_chances(x.column(4).to_numpy(), k), cell_chances(x.column(5).to_numpy(), k), threshold)
                yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], ["a", "b"]).filter(pa.array(ok))

    joined = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "ra", "rb", "na", "nb")
    return joined.mapInArrow(run, "a long, b long")


def _dealt(members: DataFrame, labels: DataFrame, nodes: DataFrame, complete: bool) -> DataFrame:
    """Members of bands with several components, once for each pair of blocks they are in; unless ``complete``,
    only of crowded bands, and of their pairs those of the first block and those of a block with itself.

    A component of more than half a block has blocks of its own, which are never paired with each other; others
    are in one block as a whole."""
    labelled = members.select("band", "node").join(labels, "node").join(nodes.select("node", "n_shingles"), "node")
    load = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    of_band = (labelled.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), load.alias("load"))
               .where("lo <> hi").select("band", "load"))
    columns = ["band", "i", "j", "block", "node", "label", "n_shingles"]
    zero = F.lit(0).cast("long")
    labelled = written(labelled.join(of_band if complete else of_band.where("load > 1"), "band"), "band-labelled")
    crowded = labelled.where("load > 1")
    of_label = crowded.groupBy("band", "label").agg(load.alias("own"))
    large = F.col("own") > 0.5
    crowded = crowded.join(of_label, ["band", "label"]).withColumns({
        "sole": F.when(large, F.col("label")),
        "part": F.when(large, F.pmod(F.xxhash64("node"), F.ceil("own")))
        .otherwise(F.pmod(F.xxhash64(F.lit(7), "label"), F.ceil("load")))})
    crowded = crowded.withColumn("block", F.xxhash64(F.coalesce("sole", zero), F.col("sole").isNull(), "part"))
    blocks = crowded.groupBy("band", "block").agg(F.max("sole").alias("sole"))
    one, other = (blocks.select("band", F.col("block").alias(c), F.col("sole").alias(f"sole_{c}")) for c in "ij")
    if complete:
        pairs = one.join(other, "band").where("i <= j")
    else:
        first = blocks.groupBy("band").agg(F.min("block").alias("i"), F.min_by("sole", "block").alias("sole_i"))
        itself = one.select("band", "i", "sole_i", F.col("i").alias("j"), F.col("sole_i").alias("sole_j"))
        pairs = first.join(other, "band").unionByName(itself).distinct()
    pairs = pairs.where("sole_i is null or sole_j is null or sole_i <> sole_j")
    sides = pairs.select("band", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    plain = labelled.where("load <= 1").withColumns({"i": zero, "j": zero, "block": zero}).select(*columns)
    dealt = written(plain.unionByName(crowded.join(sides, ["band", "block"]).select(*columns)), "band-blocks")
    drop_written(labelled)
    return dealt


class _Blocks:
    """Rows of one pair of blocks, with the plausible partners of each."""

    def __init__(self, rows: list[tuple], threshold: float, k: int):
        band, self.i, self.j = rows[0][:3]
        self.block = np.array([r[3] for r in rows])
        self.node, self.label, self.size = (np.array([r[c] for r in rows], np.int64) for c in (4, 5, 6))
        self.registers = np.frombuffer(b"".join([r[7] for r in rows]), np.uint16).reshape(-1, k)
        self.cells, self.threshold = cell_chances(self.size, k), threshold
        keys = all_band_keys(self.registers)
        self.earlier = keys[:, :(keys[0] == band).argmax()]
        empty = ~self.registers.reshape(*keys.shape, ROWS).any(axis=2)[:, :self.earlier.shape[1]]
        self.earlier[empty] = np.nonzero(empty)[0]  # empty bands are shared with no other row

    def partners(self, x: int, wanted: np.ndarray) -> np.ndarray:
        """Later members (or those of the other block) that are wanted, may be linked with ``x``
        and share no earlier band with it."""
        y = np.flatnonzero(wanted & (
            np.minimum(self.size, self.size[x]) >= self.threshold * np.maximum(self.size, self.size[x]) - 1e-9))
        y = y[y > x] if self.i == self.j else y[self.block[y] == self.j]
        y = y[~(self.earlier[y] == self.earlier[x]).any(axis=1)]
        r, c = self.registers, self.cells
        return y[plausible(r[x], r[y], c[x], c[y], self.threshold)]

    def firsts(self) -> np.ndarray:
        return np.arange(len(self.node)) if self.i == self.j else np.flatnonzero(self.block == self.i)


def _by_blocks(dealt: DataFrame, work, schema: str) -> DataFrame:
    """``work(rows)``, record batches, for the rows of each pair of blocks; one pair is held at a time."""
    def run(batches):
        rows = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if rows and rows[0][:3] != row[:3]:
                    yield work(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield work(rows)

    return dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(run, schema)


def _with_partners(dealt: DataFrame, threshold: float, k: int) -> DataFrame:
    """``band, i, j, node`` of members with a plausible partner."""
    def work(rows):
        blocks = _Blocks(rows, threshold, k)
        found = np.zeros(len(rows), bool)
        for x in blocks.firsts():
            # Of members known to have partners, only those of others are still asked for.
            y = blocks.partners(x, (blocks.label != blocks.label[x]) & ~(found & found[x]))
            found[y] = True
            found[x] |= len(y) > 0
        at = np.flatnonzero(found)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), v), t) for v, t in zip(rows[0], [pa.int64()] * 3)]
            + [pa.array(blocks.node[at])], ["band", "i", "j", "node"])

    return _by_blocks(dealt, work, "band long, i long, j long, node long")


def intersections(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others, some at a time."""
    out, at = [], 0
    while at < len(others):
        until, held = at + 1, len(others[at])
        while until < len(others) and held + len(others[until]) <= BLOCK_SHINGLES:
            held += len(others[until])
            until += 1
        joined = np.concatenate(others[at:until])
        place = np.minimum(np.searchsorted(one, joined), len(one) - 1)
        starts = np.cumsum([0, *map(len, others[at:until - 1])])
        out.append(np.add.reduceat((one[place] == joined).astype(np.int64), starts))
        at = until
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _links_in_blocks(dealt: DataFrame, threshold: float, percent: int, k: int) -> DataFrame:
    """Links ``a, b`` confirmed on full sets that join different components of their blocks."""
    def work(rows):
        blocks = _Blocks(rows, threshold, k)
        sets = [np.frombuffer(r[8], np.uint64) for r in rows]
        label, links = blocks.label.copy(), []
        for x in blocks.firsts():
            y = blocks.partners(x, label != label[x])
            both = intersections(sets[x], [sets[z] for z in y])
            for z in y[100 * both >= percent * (blocks.size[x] + blocks.size[y] - both)]:
                if label[z] != label[x]:
                    links.append((blocks.node[x], blocks.node[z]))
                    label[label == label[z]] = label[x]
        return pa.RecordBatch.from_arrays([pa.array([int(l[c]) for l in links], pa.int64()) for c in (0, 1)], ["a", "b"])

    return _by_blocks(dealt, work, "a long, b long")


def _full_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``node, shingles``: the full sets of the nodes in ``wanted``, as bytes; of the texts only those
    that are likely wanted are shuffled."""
    wanted = written(nodes.select("node", "rep", "rep_text").join(wanted, "node", "left_semi"), "sets-wanted")
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("rep"), text_key().alias("rep_text"), "text")
    texts = Sieve(wanted.select("rep", "rep_text")).rows(texts, "rep", "rep_text")
    found = texts.join(wanted, ["rep", "rep_text"]).select("node", "text").dropDuplicates(["node"])

    def run(batches):
        for b in batches:
            sets = [shingle_set(t, width).tobytes() for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    return written(found.mapInArrow(run, "node long, shingles binary"), "full-sets")


def band_members(bands: DataFrame) -> DataFrame:
    """``band, node, lo``: members of bands that hold two or more and the smallest of them.  Of bands with the same
    members the one of the first place is left: two nodes are tested where their first shared band is."""
    dealt = bands.where("band is not null").repartition("band")  # counted and joined as it was shuffled once
    shared = dealt.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                       F.min("node").alias("lo")).where("n > 1")
    once = shared.groupBy("n", "x").agg(F.min("band").alias("band"), F.min("lo").alias("lo")).select("band", "lo")
    return dealt.join(once, "band")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    sides = [sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab"]

    def run(batches):
        for x in batches:
            one, other = ([np.frombuffer(s, np.uint64) for s in x.column(c).to_pylist()] for c in (2, 3))
            both = [len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(one, other)]
            ok = [100 * n >= percent * (len(p) + len(q) - n) for n, p, q in zip(both, one, other)]
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "sa", "sb")
    return joined.mapInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, width: int, percent: int, keys: dict[str, Column]) -> DataFrame:
    """``doc_id, n_shingles, node, label, component`` and the given keys per row of ``docs``: the
    group (null for the empty set) and the smallest id in it."""
    threshold = percent / 100
    k = ROWS * bands_for(threshold)
    found = written(signatures(docs, width, k, {"_text": text_key()} | keys), "signatures")
    # The row that stands for a node: of the smallest id, null last.
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text")
    nodes = written(found.where("node is not null").groupBy("node").agg(
        F.min(row).alias("row"), F.first("registers").alias("registers"), F.first("n_shingles").alias("n_shingles"))
        .select("node", F.col("row.doc_id").alias("first_id"), "registers", "n_shingles",
                F.coalesce("row.doc_id", F.lit(NO_ID)).alias("rep"), F.col("row._text").alias("rep_text")), "near-nodes")
    bands = written(_bands(nodes, k), "bands")
    members = written(band_members(bands), "band-members")
    drop_written(bands)
    labels = members.select("node").distinct().withColumn("label", F.col("node"))

    def merge(links: DataFrame, labels: DataFrame) -> DataFrame:
        ends = [labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab"]
        linked = links.join(ends[0], "a").join(ends[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
        to = components(linked).select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        return written(labels.join(to, F.col("label") == F.col("_n"), "left")
                       .select("node", F.coalesce("_l", "label").alias("label")), "near-labels")

    # Each node with the smallest node of each of its bands.
    pairs = members.select(F.col("lo").alias("a"), F.col("node").alias("b")).where("a <> b").distinct()
    pairs = written(_register_test(pairs, nodes, threshold, k), "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _full_sets(ends, nodes, docs, width)
    labels = merge(written(_confirmed(pairs, sets, percent), "near-links"), labels)
    drop_written(sets)
    # Bands of more than one component, in blocks; crowded ones first by pairs that grow with the members only.
    registers = nodes.select("node", "registers")
    for complete in (False, True):
        dealt = _dealt(members, labels, nodes, complete)
        if dealt.isEmpty():
            continue
        partnered = written(_with_partners(dealt.join(registers, "node").select(*dealt.columns, "registers"), threshold, k),
                            "partnered")
        sets = _full_sets(partnered.select("node").distinct(), nodes, docs, width)
        asked = (dealt.join(partnered, ["band", "i", "j", "node"]).join(registers, "node").join(sets, "node")
                 .select(*dealt.columns, "registers", "shingles"))
        labels = merge(written(_links_in_blocks(asked, threshold, percent, k), "near-links"), labels)
        for scratch in (sets, dealt, partnered):
            drop_written(scratch)
    final = nodes.select("node", "first_id").join(labels, "node", "left").select(
        "node", "first_id", F.coalesce("label", "node").alias("label"))
    smallest = final.groupBy("label").agg(F.min("first_id").alias("component"))
    of_node = final.join(smallest, "label").select(F.col("node").alias("_node"), "label", "component")
    out = found.select("doc_id", "n_shingles", "node", *keys).join(of_node, F.col("node") == F.col("_node"), "left")
    return out.drop("_node")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    out = _grouped(docs, width, percent, {})
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


@any_columns
def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each group stays, of the smallest
    id (null last), then by a hash of id and text; of rows equal in both, any one.  Rows
    of the empty set all stay."""
    keys = list(row_keys())
    rows = written(_grouped(docs, width, percent, row_keys()).where("node is not null")
                   .groupBy("label", "doc_id", *keys).agg(F.count(F.lit(1)).alias("n")), "near-rows")
    best = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *keys)).alias("best"))
    stays = (F.col("best._k1") == F.col("_k1")) & (F.col("best._k2") == F.col("_k2"))
    judged = rows.join(best, "label").select(*keys, stays.alias("stays"), "n")
    judged = written(judged.where(~F.col("stays") | (F.col("n") > 1)), "near-verdicts")
    keyed = docs.withColumns(row_keys())
    repeated = keyed.join(judged.where("stays").select(*keys), keys, "left_semi").dropDuplicates(keys)
    return keyed.join(judged.select(*keys), keys, "left_anti").unionByName(repeated).select(*docs.columns)
