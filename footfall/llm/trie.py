"""Prefix trie of conversations by union-find over neighbours' common prefixes.

A conversation is a path of turns, a turn 32 hex digits of a digest of its role and text.  Paths are
cut into segments of ``SEGMENT`` turns; segments with the same turns before them are a group, the
trie of a group hangs below one node of the segments above, and groups are worked off level by
level, deepest first, so no row and no open chain is longer than a segment.

Segments of a level are sorted in ranges.  In a range, neighbours with the longest common prefix are
joined first: union-find over the edges between neighbours in descending depth.  When a component
is joined at depth ``d``, the chain of its nodes below ``d`` is complete and is given out with the
sums of its subtree; the joined component is the branching node at ``d``.  Only prefixes of the
first and the last segment of a range may go on in other ranges: the forest of a range is contracted
to these (at most ``2 * SEGMENT`` nodes, with the sums of what hangs below them), and contracted
forests are merged by the nodes' digests.  Their number is bounded by settings (ranges and
``SEGMENT``), not by the input.

Turns are numbered in ranges too, so a conversation with a third of all rows is many tasks; its
levels, as many as its turns / ``SEGMENT``, follow one another.  ``ends_sha256`` is a running digest
over ids in order: the ids of conversations that are equal as a whole are hashed by one task, one
batch held at a time.

Defined results: a null role or text is the empty one; rows without a ``conv_id`` belong to no
conversation; turns with one number (or none) follow one another by role, then by the digest of
role and text, and repeated rows are repeated turns; ``%`` keeps the sign of the id; without any
conversation there is no node, not even the root.  Only the named columns are read, so other
columns may have any names.  Very long texts are only hashed and counted, in the scan.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, shuffle_partitions, text_of, written

SEGMENT = 512
DIGITS = 32
_NODE = ("key string, parent_key string, p string, depth long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, words long, spine boolean")
NODE_COLUMNS = [c.split(" ")[0] for c in _NODE.split(", ")]


def numbered_turns(rows: DataFrame) -> DataFrame:
    """``conv, i, key, words`` per turn: its place in the conversation from 0, its digest, its words."""
    role, text = text_of("role"), text_of("text")
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "key"]
    ranged = turns.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for x in batches:
            if len(x):
                conv = x.column(0).to_numpy()
                starts = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
                i = np.arange(len(conv)) - np.repeat(starts, np.diff([*starts, len(conv)]))
                if conv[0] == last:
                    i[:starts[1] if len(starts) > 1 else len(conv)] += seen
                last, seen = conv[-1], i[-1] + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(conv), part), pa.int32()), x.column(0), pa.array(i, pa.int64()), *x.columns[1:]],
                    ["part", "conv", "i", "key", "words"])

    local = written(ranged.select("conv", "key", "words").mapInArrow(
        run, "part int, conv long, i long, key string, words long"), "turns")
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # Conversations that began in an earlier range: one per range at most.
    later = (local.groupBy("conv", "part").agg((F.max("i") + 1).alias("n")).withColumn("before", before)
             .where("before > 0").select("conv", "part", "before"))
    return local.join(F.broadcast(later), ["conv", "part"], "left").select(
        "conv", (F.col("i") + F.coalesce("before", F.lit(0))).alias("i"), "key", "words")


def own_paths(turns: DataFrame) -> DataFrame:
    """``conv, depth, key, words``: every conversation as it is, with a row of depth 0 for its start."""
    return turns.select("conv", (F.col("i") + 1).alias("depth"), "key", "words").unionByName(_starts(turns))


def shared_paths(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """As ``own_paths``, with the first ``crc32(id) % most`` turns of each conversation replaced by
    as many first turns of the conversation ``id - id % every`` (all if it has fewer, none if absent)."""
    lead = F.col("conv") - F.col("conv") % every
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    heads = turns.where((F.col("i") < most - 1) & (F.col("conv") % every == 0)).select(
        F.col("conv").alias("lead"), F.col("i").alias("at"), "key", "words")
    length = heads.groupBy("lead").agg(F.count(F.lit(1)).alias("length"))
    convs = turns.select("conv").distinct().withColumns({"lead": lead, "taken": taken})
    first = convs.join(heads, "lead").where("at < taken").select("conv", (F.col("at") + 1).alias("depth"), "key", "words")
    rest = (turns.withColumns({"lead": lead, "taken": taken}).where("i >= taken").join(length, "lead", "left")
            .select("conv", (F.col("i") - F.col("taken") + F.least("taken", F.coalesce("length", F.lit(0))) + 1)
                    .alias("depth"), "key", "words"))
    return first.unionByName(rest).unionByName(_starts(turns))


def _starts(turns: DataFrame) -> DataFrame:
    return turns.select("conv").distinct().select("conv", F.lit(0).cast("long").alias("depth"), F.lit("").alias("key"),
                                                  F.lit(0).cast("long").alias("words"))


def _segments(paths: DataFrame) -> DataFrame:
    """``conv, k, p, seg, ws, more, next_p``: a conversation's segments; ``p`` stands for all turns
    before the segment, ``next_p`` for those up to its end."""
    k = F.greatest(F.floor((F.col("depth") - 1) / SEGMENT), F.lit(0)).cast("int")
    items = F.sort_array(F.collect_list(F.struct("depth", "key", "words")))
    cut = (paths.groupBy("conv", k.alias("k")).agg(items.alias("items"))
           .select("conv", "k", F.array_join(F.transform("items", lambda x: x.key), "").alias("seg"),
                   F.transform(F.filter("items", lambda x: x.depth > 0), lambda x: x.words).alias("ws")))
    by = Window.partitionBy("conv").orderBy("k")
    before = F.collect_list(F.md5("seg")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    so_far = F.collect_list(F.md5("seg")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumns({"more": F.lead("k").over(by).isNotNull(), "p": F.md5(F.array_join(before, "")),
                            "next_p": F.md5(F.array_join(so_far, ""))})


def node_key(k: int, p: str, seg: str, depth: int) -> str:
    return hashlib.md5(f"{k}|{p}|{seg[:DIGITS * depth]}".encode()).hexdigest()


def common_turns(a: str, b: str) -> int:
    """Number of leading turns that two segments share."""
    low, high = 0, min(len(a), len(b)) // DIGITS
    if a[:DIGITS * high] == b[:DIGITS * high]:
        return high
    while low < high:  # the first of them differ in turn `high` or before
        mid = (low + high + 1) // 2
        if a[:DIGITS * mid] == b[:DIGITS * mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Forest:
    """The trie of a range of sorted segments of level ``k``; ``nodes`` collects rows of ``_NODE``.

    A row is ``p, seg, ws, more, conv, n_children, n_leaves, saved_tokens``, the last three of what
    hangs below its end in the next level, given with one row of each end.
    """

    def __init__(self, k: int, rows: list[tuple]):
        self.k, self.rows, self.nodes = k, rows, []
        n = len(rows)
        self.up = list(range(n))
        self.bottom = [len(r[1]) // DIGITS for r in rows]
        self.convs, self.least = [1] * n, [r[4] for r in rows]
        self.children, self.leaves, self.saved = ([r[c] for r in rows] for c in (5, 6, 7))
        self.below: list[list[int]] = [[] for _ in rows]  # nodes whose parent is not given out yet
        self.spine = [i in (0, n - 1) for i in range(n)]
        shared = [-1] * n
        for i in range(1, n):
            if rows[i][0] == rows[i - 1][0]:
                shared[i] = common_turns(rows[i][1], rows[i - 1][1])
        for i in sorted(range(1, n), key=lambda i: -shared[i]):
            if shared[i] < 0:
                break
            self._join(self._find(i - 1), self._find(i), shared[i])
        for i in range(n):
            if self._find(i) == i:
                self._lift(i, 0)
                self._give(i, 0, None, None)

    def _find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def _join(self, a: int, b: int, depth: int) -> None:
        self._lift(a, depth)
        self._lift(b, depth)
        if len(self.below[a]) < len(self.below[b]):
            a, b = b, a
        self.up[b] = a
        self.below[a] += self.below[b]
        self.least[a] = min(self.least[a], self.least[b])
        self.spine[a] |= self.spine[b]
        for sums in (self.convs, self.children, self.leaves, self.saved):
            sums[a] += sums[b]

    def _lift(self, x: int, depth: int) -> None:
        """Give out the chain of nodes of a component down to, but without, ``depth``."""
        p, seg = self.rows[x][:2]
        while self.bottom[x] > depth:
            at = self.bottom[x]
            up = self.least[x] if at > depth + 1 and not self.spine[x] else None
            self._give(x, at, node_key(self.k, p, seg, at - 1), up)
            self.bottom[x] = at - 1

    def _give(self, x: int, at: int, parent_key: str | None, parent: int | None) -> None:
        p, seg, ws = self.rows[x][:3]
        words = ws[at - 1] if at else 0
        for i in () if self.spine[x] else self.below[x]:
            self.nodes[i][5] = self.least[x]
        if not self.spine[x]:
            if not self.children[x]:
                self.leaves[x] = 1
            self.saved[x] += (self.convs[x] - 1) * words
        self.nodes.append([node_key(self.k, p, seg, at), parent_key, p, at, self.least[x], parent, self.convs[x],
                           self.children[x], self.leaves[x], self.saved[x], words, self.spine[x]])
        if self.spine[x]:  # what hangs below stays with this node until the forests are merged
            self.children[x] = self.leaves[x] = self.saved[x] = 0
            self.below[x] = []
        else:
            self.children[x], self.below[x] = 1, [len(self.nodes) - 1]


def _forests(rows: DataFrame, k: int) -> DataFrame:
    """Nodes (``_NODE``, depth inside the segment) of the forest of each range."""
    order = ["p", "seg", "more", "conv"]
    ranged = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches):
        held = []
        for x in batches:
            held += zip(*(c.to_pylist() for c in x.columns))
        if held:
            nodes = Forest(k, held).nodes
            types = [pa.string()] * 3 + [pa.int64()] * 8 + [pa.bool_()]
            for at in range(0, len(nodes), 20_000):
                columns = zip(*nodes[at:at + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], NODE_COLUMNS)

    return ranged.select("p", "seg", "ws", "more", "conv", "n_children", "n_leaves", "saved_tokens").mapInArrow(run, _NODE)


def merge_contracted(rows: list[tuple]) -> list[list]:
    """Contracted forests (rows of ``_NODE``) merged by key: sums of parts added up, then carried to
    parents in descending depth."""
    nodes: dict[str, list] = {}
    for r in rows:
        if (x := nodes.get(r[0])) is None:
            nodes[r[0]] = [*r]
        else:
            x[4] = min(x[4], r[4])
            for c in (6, 7, 8, 9):
                x[c] += r[c]
    for x in sorted(nodes.values(), key=lambda x: -x[3]):
        if not x[7]:
            x[8] = 1
        x[9] += (x[6] - 1) * x[10]
        if x[1] is not None:
            parent = nodes[x[1]]
            x[5] = parent[4]
            parent[7] += 1
            parent[8] += x[8]
            parent[9] += x[9]
    return list(nodes.values())


def _end_digests(segments: DataFrame) -> DataFrame:
    """``end_key, ends_sha256`` of nodes where conversations end."""
    key = F.md5(F.concat(F.col("k").cast("string"), F.lit("|"), "p", F.lit("|"), "seg"))
    ends = segments.where("not more").select(key.alias("end_key"), "conv")

    def run(batches):
        last, digest = None, None
        for x in batches:
            found: list[tuple[str, str]] = []
            for key, conv in zip(x.column(0).to_pylist(), x.column(1).to_pylist()):
                if key == last:
                    digest.update(b",%d" % conv)
                else:
                    if last is not None:
                        found.append((last, digest.hexdigest()))
                    last, digest = key, hashlib.sha256(b"%d" % conv)
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.string()) for c in (0, 1)],
                                             ["end_key", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([digest.hexdigest()])], ["end_key", "ends_sha256"])

    return (ends.repartition("end_key").sortWithinPartitions("end_key", "conv")
            .mapInArrow(run, "end_key string, ends_sha256 string"))


def trie(paths: DataFrame) -> DataFrame:
    """Nodes of the trie of ``paths`` (``conv, depth, key, words``, as ``own_paths`` gives them):
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    spark = paths.sparkSession
    segments = written(_segments(paths), "segments")
    levels, roots = [], None
    for k in range(segments.agg(F.max("k")).first()[0] or 0, -1, -1):
        rows = segments.where(F.col("k") == k)
        if roots is None:
            rows = rows.withColumns({c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved_tokens")})
        else:
            rows = rows.join(roots, (F.col("next_p") == F.col("root_p")) & (F.col("conv") == F.col("root_conv")) & F.col("more"),
                             "left").fillna(0, ["n_children", "n_leaves", "saved_tokens"])
        found = written(_forests(rows, k), "forests")
        merged = spark.createDataFrame(merge_contracted(found.where("spine").collect()), _NODE)
        up = merged.select(F.col("key").alias("up_key"), F.col("conv_id").alias("up_conv"))
        closed = (found.where("not spine").join(F.broadcast(up), F.col("parent_key") == F.col("up_key"), "left")
                  .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv")).select(*NODE_COLUMNS))
        nodes = closed.unionByName(merged)
        roots = nodes.where("depth = 0").select(F.col("p").alias("root_p"), F.col("conv_id").alias("root_conv"),
                                                "n_children", "n_leaves", "saved_tokens")
        if k:  # the parent at the cut has all members of the level above, those that end there too
            above = (segments.where(F.col("k") == k - 1).groupBy(F.col("next_p").alias("above_p"))
                     .agg(F.min("conv").alias("above_conv")))
            nodes = nodes.where("depth > 0").join(above, F.col("p") == F.col("above_p"), "left").withColumn(
                "parent_conv_id", F.when(F.col("depth") == 1, F.col("above_conv")).otherwise(F.col("parent_conv_id")))
        levels.append(nodes.select(*NODE_COLUMNS).withColumn("depth", F.col("depth") + k * SEGMENT))
    out = levels[0]
    for nodes in levels[1:]:
        out = out.unionByName(nodes)
    out = out.join(_end_digests(segments), F.col("key") == F.col("end_key"), "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def shared_trie(rows: DataFrame) -> DataFrame:
    """The trie of the conversations ``rows`` (``conv_id, turn, role, text``) with shared first turns."""
    return trie(shared_paths(numbered_turns(rows)))
