"""Alignment of two tokenizers by galloping intersection of their token ends.

A text is encoded by a byte-level BPE (A) and by a sentencepiece model (B).  The byte offsets
where tokens end are two increasing lists; the shorter one drives an exponential, then binary,
search into the longer one (all its offsets at once, in numpy).  Common offsets cut both lists
into groups that cover the same bytes; the difference of neighbouring ranks in a list is the
range of its tokens in a group.  Tokens that end together are *linked*.

Of two tokens that end together the bytes of one are a suffix of the other's.  So the id pairs
that can be linked are known from the two vocabularies alone (``Aligner.pairs``; their number is
at most the bytes in both vocabularies, some hundred thousand, whatever the corpus).  A link is
stored as its place in that list, corpus-wide counts are one small array per task, summed by
Spark, and what is sent back to the tasks is bounded by the vocabularies.

Defined results: a text that is null or empty, or that a tokenizer does not give back byte by
byte (normalised characters, unknown pieces), has no tokens: zeros, and ``''`` for the digest.
Strings of special tokens inside a text are plain text.  Tokens without bytes end nowhere and are
in no link.  Rows are independent, so equal rows and rows with one id get a result each; an empty
table gives an empty table.  A very long text is one array of ids at a time in a task (some 30
bytes a byte of text).  Only the named columns are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .bpe import CACHE_ENTRIES, CACHED_CHARS, MergeList
from .common import written

#: The mark of a space in sentencepiece pieces (fixed value of that format).
SPACE_MARK = "▁"
#: Links a task holds before it adds them to its counts.
HELD_LINKS = 1 << 22


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Places in ``long`` (increasing) of the first value not below each of ``short``: from a guess,
    steps double until they bracket the value, then halve."""
    n, m = len(short), len(long)
    guess = np.arange(n, dtype=np.int64) * m // max(n, 1)
    low, high = guess.copy(), guess.copy()  # wanted: long[low - 1] < value <= long[high]
    step = 1
    left = np.flatnonzero((low > 0) & (long[np.maximum(low, 1) - 1] >= short))
    while len(left):
        high[left] = low[left] - 1
        low[left] = np.maximum(low[left] - step, 0)
        left = left[(low[left] > 0) & (long[np.maximum(low[left], 1) - 1] >= short[left])]
        step *= 2
    step = 1
    right = np.flatnonzero((high < m) & (long[np.minimum(high, m - 1)] < short)) if m else np.empty(0, np.int64)
    while len(right):
        low[right] = high[right] + 1
        high[right] = np.minimum(high[right] + step, m)
        right = right[(high[right] < m) & (long[np.minimum(high[right], m - 1)] < short[right])]
        step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        mid = (low[open_] + high[open_]) >> 1
        below = long[mid] < short[open_]
        low[open_[below]] = mid[below] + 1
        high[open_[~below]] = mid[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in ``a`` and in ``b`` (both increasing) of their common values."""
    if len(a) > len(b):
        return common_ends(b, a)[::-1]
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = gallop(a, b)
    at = np.flatnonzero((place < len(b)) & (b[np.minimum(place, len(b) - 1)] == a))
    return at, place[at]


class Aligner:
    """Both tokenizers, the bytes of their tokens and the id pairs that can end together."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        merges = MergeList(path_a)
        merges.specials, merges.special_pattern = {}, None  # their strings are plain text here
        self.merges = merges
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [merges.token_bytes.get(i, b"") for i in range(max(merges.token_bytes) + 1)]
        self.bytes_b = [self._piece_bytes(i) for i in range(self.model.get_piece_size())]
        self.len_a, self.len_b = (np.array([*map(len, t)], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.text_a, self.text_b = ([str(i) for i in range(len(t))] for t in (self.bytes_a, self.bytes_b))
        self.pairs = self._pairs()
        # A breaks before a single space and, if no piece of B goes on behind its leading spaces, no
        # merge of B crosses it: ids of a text are those of the parts between such spaces.
        self.units_are_apart = not any(
            SPACE_MARK in self.model.id_to_piece(i).lstrip(SPACE_MARK) for i in range(self.model.get_piece_size()))
        self.known: dict[str, tuple[bytes, bytes]] = {}  # this generation and the one before, which is
        self.older: dict[str, tuple[bytes, bytes]] = {}  # dropped when this one is full

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def _pairs(self) -> np.ndarray:
        """Codes (``a << 32 | b``, increasing) of ids whose bytes are a suffix one of the other's."""
        by_bytes: tuple[dict, dict] = ({}, {})
        for found, tokens in zip(by_bytes, (self.bytes_a, self.bytes_b)):
            for i, t in enumerate(tokens):
                if t:
                    found.setdefault(t, []).append(i)
        codes = set()
        for a, t in enumerate(self.bytes_a):
            for k in range(len(t)):
                codes.update(a << 32 | b for b in by_bytes[1].get(t[k:], ()))
        for b, t in enumerate(self.bytes_b):
            for k in range(1, len(t)):
                codes.update(a << 32 | b for a in by_bytes[0].get(t[k:], ()))
        return np.array(sorted(codes), np.int64)

    def _checked(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of texts by A and by B as bytes of unsigned 32-bit integers; None where one of the
        tokenizers does not give back space and text."""
        out = []
        for t, b in zip(texts, self.model.encode(texts, num_threads=1) if texts else ()):
            whole = b" " + t.encode()
            # Letters behind one space are one pre-token of A.
            a = self.merges.merge_all(whole) if len(whole) <= 64 and t.isalpha() else [*self.merges.encode(" " + t)]
            same = (b"".join([self.bytes_a[i] for i in a]) == whole and b"".join([self.bytes_b[i] for i in b]) == whole)
            out.append((array("I", a).tobytes(), array("I", b).tobytes()) if same else None)
        return out

    def encode(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids by A and B per text; none where one of them does not give back space and text.

        Texts are cut into the parts between single spaces, and short parts are remembered; a text with
        other spaces, or with a part that is not given back, is encoded as a whole.
        """
        if len(self.known) >= CACHE_ENTRIES:
            self.known, self.older = {}, self.known
        cut, new = [], {}
        for t in texts.to_pylist():
            parts = t.split(" ") if t and self.units_are_apart else None
            if parts:
                for p in parts:
                    if p not in self.known:
                        if (ids := self.older.get(p)) is not None:
                            self.known[p] = ids
                        elif not p or p[0].isspace() or p[-1].isspace():
                            parts = None
                            break
                        else:
                            new[p] = None
            cut.append((t or "", parts))
        new = dict(zip(new, self._checked([*new])))
        out, none = [], (b"", b"")
        for t, parts in cut:
            found = [self.known.get(p) or new[p] for p in parts] if parts else [None]
            if None in found:
                found = [(t and self._checked([t])[0]) or none]
            out.append(tuple(np.frombuffer(b"".join(ids), np.uint32).astype(np.int64) for ids in zip(*found)))
        self.known |= {p: ids for p, ids in new.items() if ids is not None and len(p) <= CACHED_CHARS}
        return out

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks in the ids of A and of B that end together: the last tokens of each group."""
        if not self.len_a[a].all() or not self.len_b[b].all():  # tokens without bytes end nowhere
            ka, kb = np.flatnonzero(self.len_a[a]), np.flatnonzero(self.len_b[b])
            ra, rb = self.align(a[ka], b[kb])
            return ka[ra], kb[rb]
        return common_ends(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))

    def links(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places in ``pairs`` of linked ids."""
        return np.searchsorted(self.pairs, a << 32 | b).astype(np.uint32)

    def groups_text(self, a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2``: ids of A and B group by group."""
        ta, tb = [self.text_a[i] for i in a.tolist()], [self.text_b[i] for i in b.tolist()]
        ea, eb = (ra + 1).tolist(), (rb + 1).tolist()
        return ";".join([f"{ta[p] if q - p == 1 else ','.join(ta[p:q])}|{tb[r] if s - r == 1 else ','.join(tb[r:s])}"
                         for p, q, r, s in zip([0, *ea], ea, [0, *eb], eb)])


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, path_a: str, path_b: str, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:
    """Per row ``keep``, ``ids_a``, ``ids_b``, ``ends_a``, ``ends_b``: ids, and for every group the number of
    ids up to its end (so group ``g`` is the ids from ``ends[g - 1]`` to ``ends[g]`` of each list)."""
    def run(batches):
        both = aligner(path_a, path_b)
        for x in batches:
            found = []
            for a, b in both.encode(x.column(len(keep))):
                ra, rb = both.align(a, b)
                found.append((a, b, ra + 1, rb + 1))
            yield pa.RecordBatch.from_arrays(
                [*x.columns[:len(keep)], *(pa.array([f[i].tolist() for f in found], pa.list_(pa.int32())) for i in range(4))],
                [*keep, "ids_a", "ids_b", "ends_a", "ends_b"])

    schema = docs.select(*keep).schema
    for name in ("ids_a", "ids_b", "ends_a", "ends_b"):
        schema = schema.add(name, ArrayType(IntegerType()))
    return docs.select(*keep, docs[text].alias("_".join(["_", *keep]))).mapInArrow(run, schema)


def _with_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row the numbers and the digest of its groups, and its links packed in 4 bytes each."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]

    def run(batches):
        both = aligner(path_a, path_b)
        for x in batches:
            rows = []
            for a, b in both.encode(x.column(1)):
                ra, rb = both.align(a, b)
                links = both.links(a[ra], b[rb])
                digest = hashlib.sha256(both.groups_text(a, b, ra, rb).encode()).hexdigest() if len(a) else ""
                rows.append((len(a), len(b), len(ra), len(links), digest, links.tobytes()))
            columns = [*zip(*rows)] or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [x.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string()),
                 pa.array(columns[5], pa.binary())], names)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, links binary")


def link_counts(linked: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``pair`` (place in ``Aligner.pairs``), ``n``: how many links hold it; a task sends a row per pair
    it has seen, so at most as many as the vocabularies allow."""
    def run(batches):
        size = len(aligner(path_a, path_b).pairs)
        counts, held, n = np.zeros(size, np.int64), [], 0
        for x in batches:
            held += [np.frombuffer(v, np.uint32) for v in x.column(0).to_pylist()]
            n += sum(map(len, held[-len(x):])) if len(x) else 0
            if n >= HELD_LINKS:
                counts += np.bincount(np.concatenate(held), minlength=size)
                held, n = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=size)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["pair", "n"])

    return linked.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align_digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best``: links whose pair has the highest count of all pairs of its B id (ties included);
    ``count_sum``: counts of the links' pairs, summed over links.
    """
    linked = written(_with_links(docs, path_a, path_b), "aligned")
    counts = link_counts(linked, path_a, path_b).toArrow()  # bounded by the vocabularies, see above
    pairs, n = counts.column("pair").to_numpy(), counts.column("n").to_numpy()
    of_pair = docs.sparkSession.sparkContext.broadcast((pairs.astype(np.uint32), n))

    def run(batches):
        both = aligner(path_a, path_b)
        at, found = of_pair.value
        count = np.zeros(len(both.pairs), np.int64)
        count[at] = found
        of_b = both.pairs & 0xFFFFFFFF
        highest = np.zeros(len(both.bytes_b), np.int64)
        np.maximum.at(highest, of_b, count)
        best = count == highest[of_b]
        for x in batches:
            links = [np.frombuffer(v, np.uint32) for v in x.column(x.schema.get_field_index("links")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*x.columns[:5], pa.array([int(best[i].sum()) for i in links], pa.int64()),
                 pa.array([int(count[i].sum()) for i in links], pa.int64()), x.column(5)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return linked.mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
        "n_best long, count_sum long, groups_sha256 string")
