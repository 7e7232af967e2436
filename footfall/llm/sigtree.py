"""N-gram Jaccard join by signature trees.

A document's set is its distinct word shingles, as 64-bit hashes (two of n different shingles meet
with a chance of n**2 / 2**65).  Equal sets are one node (64 bits of a digest of the set).  A node's
signature is a bitmap of about four bits a shingle.  Nodes that may be linked meet in a group; each
group is a *signature tree*: leaves are members, inner nodes hold the OR of the bitmaps below, the
range of set sizes, and the fewest bits a member must share with a partner.  A dual traversal from
(root, root) drops pairs of tree nodes whose sizes are too far apart, whose common bits are fewer
than one of them needs, or which are known to be one component.  What is left are pairs whose
bitmaps allow the wanted overlap; full sets decide.  A group's members get bitmaps folded to a quarter first,
whole ones if they then may have a partner of another component, and full sets if they still may.

Groups.  Under any one order of all shingles, two sets that share ``need`` of ``n`` shingles share one
among the first ``n - need + 1`` of each.  So a node is a member of the group of each of these
shingles, and no link is lost.  The order is by hash, but shingles of many nodes (``HOT`` or more, at
most ``HOT_LISTED`` of them) come last, rarest first: they form groups only of sets that hold little
else.  Which shingles are taken for hot changes the work, not the result.  Groups with the same
members are one (by count and a 64-bit hash), and a group whose members are all in one of each
other's ``LARGEST`` largest groups is dropped for that one.  A group is cut into bands of set sizes a
factor of the threshold apart; a node is also a foreign member of the band below if a partner can
be there.  Groups with the same members in a band are one there, too.

Rounds.  The links wanted are those that join components.  Round one asks each node's largest
group, round two its three largest, round three all groups; before each, groups of one component
are dropped.  A crowded group is dealt out as pairs of blocks of about ``BLOCK`` members: a component of
more than half a block has blocks of its own, never paired with each other.  Rounds one and two
pair the first block with each other one, so their rows grow with the members; round three, which
is complete, pairs all blocks that may hold different components.  Documents that are many and close
to, but below, the threshold thus still cost the square of their number over ``BLOCK`` in round three.

Defined results: null, empty or blank text has the empty set, size 0, and is linked with
nothing; texts of fewer words than a shingle have one shingle, all their words; rows with one ``doc_id``
and different texts are different nodes; a null ``doc_id`` takes part, its component is the
smallest id reachable (null if there is none); equal rows get equal results; ties have no effect; an
empty table gives an empty one; only ``doc_id`` and ``text`` are read, so other columns may have any
names.  A very long text is one array of hashes in a task, 8 bytes a word.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_written, text_bytes, written
from .components import components
from .hyperminhash import NO_ID, _full_sets, intersections, mix64, node_of, shingle_set, text_key
from .sieve import Sieve

LEAST_BITS, MOST_BITS = 64, 1 << 15
FAN = 16
BLOCK = 4096
#: Shingles of at least so many nodes are put last in the order; so many of them at most (16 bytes each).
HOT, HOT_LISTED = 512, 1 << 17
#: Share of a set's smallest hashes (and their least number) that is kept with a node.
KEPT_SHARE, KEPT_LEAST = 0.2, 32
ROUNDS, LARGEST = (1, 3, None), 4
#: Members are chosen by bitmaps of a part of the width (but so many bits at least), then by whole ones.
NARROW, NARROW_LEAST = 4, 512
#: Pairs of tree nodes looked at together; shingles counted together.
FRONT, COUNTED = 1 << 14, 1 << 22


def least_overlap(n, percent: int):
    """Shingles that a set of ``n`` shares with any partner at least."""
    return -(-percent * n // 100)


def band_of(n, percent: int):
    """Band of a set size; partners are in the same or in neighbouring bands."""
    return np.floor(np.log(n) / -math.log(percent / 100 - 0.01) + 1e-9).astype(np.int64)


def bits_of_band(band: int, percent: int) -> int:
    """Bits of the bitmaps of a band: the power of two from four times its largest size on."""
    largest = (percent / 100 - 0.01) ** -(band + 1)
    return int(min(MOST_BITS, max(LEAST_BITS, 2 ** math.ceil(math.log2(4 * largest)))))


def bitmap(shingles: np.ndarray, bits: int) -> np.ndarray:
    """One bit per shingle, as 64-bit words; half the bits are the OR of both halves of the words."""
    at = mix64(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits) > 0, bitorder="little").view(np.uint64)


def fold(words: np.ndarray, bits: int) -> np.ndarray:
    while 64 * len(words) > bits:
        words = words[:len(words) // 2] | words[len(words) // 2:]
    return words


def ones(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(axis=-1, dtype=np.int64)


class SignatureTree:
    """A group as a tree; members are held in the order of ``head`` (the smallest hash of the set) and
    size, so that near-duplicates lie side by side.  ``label`` may change while pairs are asked."""

    def __init__(self, sizes, heads, words, labels, own, percent: int):
        self.percent = percent
        order = np.lexsort((sizes, heads))
        self.order, self.size, self.words = order, sizes[order], words[order]
        self.label, self.own = labels[order].copy(), own[order]
        self.count = ones(self.words)
        need = self.count - (self.size - least_overlap(self.size, percent))
        self.levels = [(self.words, self.size, self.size, need)]
        while len(self.levels[-1][1]) > 1:
            w, least, most, need = self.levels[-1]
            at = np.arange(0, len(least), FAN)
            self.levels.append((np.bitwise_or.reduceat(w, at, axis=0), np.minimum.reduceat(least, at),
                                np.maximum.reduceat(most, at), np.minimum.reduceat(need, at)))

    def _possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether members below two tree nodes may be linked: by sizes, then by the most bits they can share."""
        w, least, most, need = self.levels[level]
        ok = (100 * most[i] >= self.percent * least[j]) & (100 * most[j] >= self.percent * least[i])
        at = np.flatnonzero(ok)
        ok[at] = ones(w[i[at]] & w[j[at]]) >= np.maximum(need[i[at]], need[j[at]])
        return ok

    def _pairs(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of members those of different labels whose bitmaps allow the wanted overlap."""
        ok = (self.label[x] != self.label[y]) & (self.own[x] | self.own[y])
        x, y = x[ok], y[ok]
        a, b = self.size[x], self.size[y]
        overlap = -(-self.percent * (a + b) // (100 + self.percent))
        ok = np.flatnonzero(overlap <= np.minimum(a, b))
        x, y, a, b, overlap = x[ok], y[ok], a[ok], b[ok], overlap[ok]
        both = ones(self.words[x] & self.words[y])
        ok = both >= np.maximum(self.count[x] - (a - overlap), self.count[y] - (b - overlap))
        return x[ok], y[ok]

    def _apart(self, level: int, i: np.ndarray, j: np.ndarray, settled: np.ndarray | None) -> np.ndarray:
        """Whether pairs of tree nodes above ``level`` may still hold members of different components
        (and, with ``settled``, members not settled yet)."""
        at = np.arange(0, len(self.size), FAN ** level)
        low, high = np.minimum.reduceat(self.label, at), np.maximum.reduceat(self.label, at)
        ok = (low[i] != high[i]) | (low[j] != high[j]) | (low[i] != low[j])
        if settled is not None:
            done = np.logical_and.reduceat(settled, at)
            ok &= ~(done[i] & done[j])
        return ok

    def traverse(self, settled: np.ndarray | None = None):
        """Pairs of members ``(x, y)`` (places in tree order), some at a time, that may be linked."""
        n = len(self.size)
        if n <= FAN:
            yield self._pairs(*np.triu_indices(n, 1))
            return
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, i, j = stack.pop()
            if len(i) > FRONT:
                stack += [(level, i[at:at + FRONT], j[at:at + FRONT]) for at in range(0, len(i), FRONT)][::-1]
                continue
            keep = self._apart(level, i, j, settled)
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            if len(i) * FAN * FAN > FRONT * FAN and len(i) > 1:
                half = len(i) // 2
                stack += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
                continue
            below = len(self.levels[level - 1][1])
            x = (i[:, None, None] * FAN + np.arange(FAN)[None, :, None]).repeat(FAN, axis=2).ravel()
            y = (j[:, None, None] * FAN + np.arange(FAN)[None, None, :]).repeat(FAN, axis=1).ravel()
            ok = (x < below) & (y < below) & ((x < y) if level == 1 else (x <= y))
            x, y = x[ok], y[ok]
            if level == 1:
                yield self._pairs(x, y)
            else:
                ok = self._possible(level - 1, x, y)
                stack.append((level - 1, x[ok], y[ok]))

    def partnered(self) -> np.ndarray:
        """Places (in the given order) of members that may be linked with one of another label."""
        found = np.zeros(len(self.size), bool)
        for x, y in self.traverse(found):
            found[x] = found[y] = True
        return self.order[found]

    def links(self, sets: list[np.ndarray]):
        """Pairs of places (in the given order) whose full sets are linked and join components."""
        out = []
        for x, y in self.traverse():
            for one in np.unique(x):
                others = y[x == one]
                others = others[self.label[others] != self.label[one]]
                both = intersections(sets[self.order[one]], [sets[self.order[z]] for z in others])
                for z in others[100 * both >= self.percent * (self.size[one] + self.size[others] - both)]:
                    if self.label[z] != self.label[one]:
                        out.append((self.order[one], self.order[z]))
                        self.label[self.label == self.label[z]] = self.label[one]
        return out


def _signed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, _text, n_shingles, node, head, low, bits`` per row: ``low`` are the smallest hashes."""
    names = ["doc_id", "_text", "n_shingles", "node", "head", "low", "bits"]

    def run(batches):
        for x in batches:
            rows = []
            for t in text_bytes(x.column(2)):
                s = shingle_set(t, width)
                if len(s):
                    low = s[:max(KEPT_LEAST, math.ceil(KEPT_SHARE * len(s)))]
                    bits = bitmap(s, bits_of_band(int(band_of(len(s), percent)), percent))
                    rows.append((len(s), node_of(s), int(s[:1].view(np.int64)[0]), low.tobytes(), bits.tobytes()))
                else:
                    rows.append((0, None, None, None, None))
            columns = [*zip(*rows)] or [()] * 5
            types = [pa.int64()] * 3 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays(
                [x.column(0), x.column(1), *(pa.array(c, t) for c, t in zip(columns, types))], names)

    return docs.select("doc_id", text_key().alias("_text"), "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _text long, n_shingles long, node long, head long, "
        "low binary, bits binary")


def _hot(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (increasing) and counts of shingles of many nodes, as far as kept hashes show them.

    A task sends what it sees twice or more; missing one costs time, not results.
    """
    def run(batches):
        held, n = [], 0

        def counted():
            token, count = np.unique(np.concatenate(held), return_counts=True)
            often = count > 1
            return pa.RecordBatch.from_arrays([pa.array(token[often].view(np.int64)), pa.array(count[often])], ["token", "n"])

        for x in batches:
            for v in x.column(0).to_pylist():
                held.append(np.frombuffer(v, np.uint64))
                n += len(held[-1])
            if n >= COUNTED:
                yield counted()
                held, n = [], 0
        if held:
            yield counted()

    found = (nodes.select("low").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= HOT).orderBy(F.col("n").desc(), "token").limit(HOT_LISTED).toArrow())
    token, n = found.column("token").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


def first_shingles(low: np.ndarray, size: int, hot: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray | None:
    """The first ``size - need + 1`` shingles of a set in the common order, from its smallest hashes;
    None if these do not suffice."""
    n = size - least_overlap(size, percent) + 1
    token, count = hot
    if not len(token):
        return low[:n] if len(low) >= n else None
    at = np.minimum(np.searchsorted(token, low), len(token) - 1)
    is_hot = token[at] == low
    cold = low[~is_hot]
    if len(cold) >= n:
        return cold[:n]
    if len(low) < size:
        return None
    last = np.flatnonzero(is_hot)
    last = last[np.lexsort((low[last], count[at[last]]))]
    return np.concatenate([cold, low[last[:n - len(cold)]]])


def _memberships(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``token, node``: the groups of each node."""
    hot = nodes.sparkSession.sparkContext.broadcast(_hot(nodes))
    names = ["token", "node"]

    def given(tokens, of):
        flat = np.concatenate([*tokens, np.empty(0, np.uint64)]).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(flat), pa.array(np.repeat(np.array(of, np.int64), [*map(len, tokens)]))], names)

    def run(batches):
        for x in batches:
            tokens, of, late = [], [], []
            for node, n, low in zip(*(c.to_pylist() for c in x.columns)):
                first = first_shingles(np.frombuffer(low, np.uint64), n, hot.value, percent)
                if first is None:
                    late.append(node)
                else:
                    tokens.append(first)
                    of.append(node)
            yield given(tokens, of)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(late), pa.int64()), pa.array(late, pa.int64())], names)

    def run_whole(batches):
        for x in batches:
            sets = [np.frombuffer(v, np.uint64) for v in x.column(1).to_pylist()]
            yield given([first_shingles(v, len(v), hot.value, percent) for v in sets], x.column(0).to_pylist())

    found = written(nodes.select("node", "n_shingles", "low").mapInArrow(run, "token long, node long"), "jaccard-first")
    sets = _full_sets(found.where("token is null").select("node"), nodes, docs, width)
    late = written(sets.mapInArrow(run_whole, "token long, node long"), "jaccard-late")
    drop_written(sets)
    return found.where("token is not null").unionByName(late)


def _groups(memberships: DataFrame, nodes: DataFrame) -> DataFrame:
    """``token, node, n_shingles, nth``: groups of two or more, without those that another one holds;
    ``nth`` counts a node's groups from the largest on."""
    of_group = memberships.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"))
    once = written(of_group.where("n > 1").groupBy("n", "x").agg(F.min("token").alias("token")).select("token", "n"),
                   "jaccard-shared")
    memberships = Sieve(once.select("token")).rows(memberships, "token")
    by = Window.partitionBy("node").orderBy(F.col("n").desc(), "token")
    ranked = written(memberships.join(once, "token").withColumn("nth", F.row_number().over(by)), "jaccard-ranked")
    # A group is held by another if all its members have that one among their largest.
    largest = ranked.where(F.col("nth") <= LARGEST).select("node", F.col("token").alias("by"), F.col("nth").alias("by_nth"))
    held = (ranked.join(largest, "node").where("by <> token and by_nth < nth").groupBy("token", "by", "n")
            .agg(F.count(F.lit(1)).alias("inside")).where("inside = n").select("token").distinct())
    left = ranked.join(held, "token", "left_anti").join(nodes.select("node", "n_shingles"), "node")
    return left.withColumn("nth", F.row_number().over(by)).select("token", "node", "n_shingles", "nth")


def _dealt(members: DataFrame, percent: int, complete: bool) -> DataFrame:
    """``token, band, i, j, node, n_shingles, label, own``: members (``token, node, n_shingles, label``)
    of groups with several components, by bands and, where these are crowded, by pairs of blocks."""
    ratio = -math.log(percent / 100 - 0.01)

    def band(n):
        return F.floor(F.log(n.cast("double")) / F.lit(ratio) + F.lit(1e-9)).cast("int")

    n = F.col("n_shingles")
    own, lowest = band(n), band(F.ceil(n * percent / 100))
    banded = (members.withColumn("own_band", own)
              .withColumn("band", F.explode(F.sequence(F.least(lowest, own), own)))
              .withColumn("own", F.col("band") == F.col("own_band")).drop("own_band"))
    of_band = (banded.groupBy("token", "band").agg(
        F.count(F.lit(1)).alias("rows"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("own").alias("owned"),
        F.bit_xor(F.xxhash64("node")).alias("x")).where("lo <> hi and owned"))
    # Of groups that differ in other bands only, one is left in this band.
    of_band = of_band.groupBy("band", "rows", "x").agg(F.min("token").alias("token")).select("token", "band", "rows")
    banded = written(banded.join(of_band, ["token", "band"]), "jaccard-banded")
    columns = ["token", "band", "i", "j", "node", "n_shingles", "label", "own"]
    zero = F.lit(0).cast("long")
    plain = banded.where(F.col("rows") <= BLOCK).withColumns({"i": zero, "j": zero}).select(*columns)
    crowded = banded.where(F.col("rows") > BLOCK)
    of_label = crowded.groupBy("token", "band", "label").agg(F.count(F.lit(1)).alias("same"))
    large = F.col("same") > BLOCK // 2
    crowded = crowded.join(of_label, ["token", "band", "label"]).withColumns({
        "sole": F.when(large, F.col("label")),
        "part": F.when(large, F.pmod(F.xxhash64("node"), F.ceil(F.col("same") / BLOCK)))
        .otherwise(F.pmod(F.xxhash64(F.lit(7), "label"), F.ceil(F.col("rows") / BLOCK)))})
    crowded = crowded.withColumn("block", F.xxhash64(F.coalesce("sole", F.lit(0)), F.col("sole").isNull(), "part"))
    blocks = crowded.groupBy("token", "band", "block").agg(F.max("sole").alias("sole"))
    other = blocks.select("token", "band", F.col("block").alias("j"), F.col("sole").alias("sole_j"))
    if complete:
        one = blocks.select("token", "band", F.col("block").alias("i"), F.col("sole").alias("sole_i"))
        pairs = one.join(other, ["token", "band"]).where("i <= j")
    else:  # the first block with each, and each with itself
        one = blocks.groupBy("token", "band").agg(F.min("block").alias("i"), F.min_by("sole", "block").alias("sole_i"))
        itself = blocks.select("token", "band", F.col("block").alias("i"), F.col("sole").alias("sole_i"),
                               F.col("block").alias("j"), F.col("sole").alias("sole_j"))
        pairs = one.join(other, ["token", "band"]).unionByName(itself).distinct()
    pairs = pairs.where("sole_i is null or sole_j is null or sole_i <> sole_j")
    sides = pairs.select("token", "band", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    return plain.unionByName(crowded.join(sides, ["token", "band", "block"]).select(*columns))


def _by_group(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(rows)``, a record batch or None, per pair of blocks (``token, band, i, j``); one is held at a time."""
    key = ["token", "band", "i", "j"]

    def run(batches):
        held = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and held[0][:4] != row[:4]:
                    if (out := work(held)) is not None:
                        yield out
                    held = []
                held.append(row)
        if held and (out := work(held)) is not None:
            yield out

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def _tree(rows: list[tuple], percent: int) -> SignatureTree:
    """The tree of rows ``token, band, i, j, node, n_shingles, label, own, head, bits, ...``."""
    words = [np.frombuffer(r[9], np.uint64) for r in rows]
    bits = 64 * min(map(len, words))  # foreign members are folded to the width of the band
    return SignatureTree(np.array([r[5] for r in rows], np.int64), np.array([r[8] for r in rows], np.int64),
                         np.stack([fold(w, bits) for w in words]),
                         np.array([r[6] for r in rows], np.int64), np.array([r[7] for r in rows], bool), percent)


def _narrow(signatures: DataFrame) -> DataFrame:
    """``signatures`` (``node, head, bits``) with bitmaps folded to a ``NARROW``th of their width."""
    def run(batches):
        for x in batches:
            words = (np.frombuffer(v, np.uint64) for v in x.column(2).to_pylist())
            folded = [fold(w, max(NARROW_LEAST, 64 * len(w) // NARROW)).tobytes() for w in words]
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(folded, pa.binary())], x.schema.names)

    return signatures.mapInArrow(run, signatures.schema)


def _partnered(dealt: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The rows of ``dealt`` of members that may be linked with one of another component of their group."""
    names = dealt.columns
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.bool_()]

    def work(rows):
        at = _tree(rows, percent).partnered()
        if len(at):
            columns = list(zip(*(rows[k][:len(names)] for k in at)))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return _by_group(dealt.join(signatures, "node").select(*names, "head", "bits"), work,
                     "token long, band int, i long, j long, node long, n_shingles long, label long, own boolean")


def _once(partnered: DataFrame) -> DataFrame:
    """``partnered`` without pairs of blocks that are left with the members of another one in the band (by count
    and a 64-bit hash): full sets are sent once for equal members, however many shingles they share."""
    key = ["token", "band", "i", "j"]
    members = partnered.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("node")).alias("x"))
    one = members.groupBy("band", "rows", "x").agg(F.min(F.struct("token", "i", "j")).alias("at"))
    return partnered.join(one.select("band", "at.*"), key, "left_semi")


def _links(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links that full sets (the last column) confirm and that join components."""
    def work(rows):
        found = _tree(rows, percent).links([np.frombuffer(r[10], np.uint64) for r in rows])
        if found:
            return pa.RecordBatch.from_arrays([pa.array([rows[f[c]][4] for f in found]) for c in (0, 1)], ["a", "b"])

    return _by_group(rows, work, "a long, b long")


def _merged(links: DataFrame, labels: DataFrame) -> DataFrame:
    ends = [labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab"]
    linked = links.join(ends[0], "a").join(ends[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    to = components(linked).select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    return written(labels.join(to, F.col("label") == F.col("_n"), "left")
                   .select("node", F.coalesce("_l", "label").alias("label")), "jaccard-labels")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``."""
    signed = written(_signed(docs, width, percent), "jaccard-signed")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text")
    nodes = written(signed.where("node is not null").groupBy("node").agg(
        F.min(row).alias("row"), *(F.first(c).alias(c) for c in ("n_shingles", "head", "low", "bits")))
        .select("node", F.col("row.doc_id").alias("first_id"), F.coalesce("row.doc_id", F.lit(NO_ID)).alias("rep"),
                F.col("row._text").alias("rep_text"), "n_shingles", "head", "low", "bits"), "jaccard-nodes")
    found = written(signed.select("doc_id", "n_shingles", "node"), "jaccard-rows")
    drop_written(signed)
    members = written(_groups(_memberships(nodes, docs, width, percent), nodes), "jaccard-groups")
    labels = members.select("node").distinct().withColumn("label", F.col("node"))
    signatures = nodes.select("node", "head", "bits")
    narrow = written(_narrow(signatures), "jaccard-narrow")
    for most in ROUNDS:
        asked = members if most is None else members.where(F.col("nth") <= most)
        dealt = written(_dealt(asked.drop("nth").join(labels, "node"), percent, most is None), "jaccard-dealt")
        likely = written(_partnered(dealt, narrow, percent), "jaccard-likely")
        drop_written(dealt)
        partnered = written(_partnered(likely, Sieve(likely.select("node")).rows(signatures, "node"), percent),
                            "jaccard-partnered")
        drop_written(likely)
        wanted = partnered.select("node").distinct()
        sets = _full_sets(wanted, nodes, docs, width)
        signed_sets = Sieve(partnered.select("node")).rows(signatures, "node").join(sets, "node")
        confirmed = _once(partnered).join(signed_sets, "node").select(*partnered.columns, "head", "bits", "shingles")
        labels = _merged(written(_links(confirmed, percent), "jaccard-links"), labels)
        for scratch in (sets, partnered):
            drop_written(scratch)
    final = nodes.select("node", "first_id").join(labels, "node", "left").select(
        "node", "first_id", F.coalesce("label", "node").alias("label"))
    smallest = final.groupBy("label").agg(F.min("first_id").alias("component"))
    of_node = final.join(smallest, "label").select(F.col("node").alias("_node"), "component")
    return (found.select("doc_id", "n_shingles", "node").join(of_node, F.col("node") == F.col("_node"), "left")
            .select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
                    .alias("component_id")))
