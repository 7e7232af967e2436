"""Byte-level BPE as a bounded-lookahead streaming transducer.

``MergeList`` reads the merge list of a byte-level BPE tokenizer file and computes its
*sufficient lookahead*: the number of bytes after a token boundary beyond which no
continuation of the input can move that boundary.  ``encode_pretoken`` merges a sliding
window of fixed size, emits the tokens whose end lies at least that far before the window's
end, and goes on from there, so its memory does not grow with the pre-token.

Why the bound holds.  Run the merges in rank order on an input ``u`` and on ``uv``.  Both
agree up to a common boundary, first the end of ``u``.  A merge ``(x, y)`` can move that
boundary left only by ``len(x)``, when ``x`` ends at it and is merged in one run only; a later
merge ``(x', y')`` that moves it again has ``x`` on the left spine of ``y'`` (``y'``, its left
part, the left part of that, ...).  The longest such chain of increasing ranks, weighed by
the lengths of the left parts, bounds the distance.

Decoding is a state machine over bytes: ids become bytes, an incremental UTF-8 decoder emits
text as soon as a character is complete and U+FFFD for each maximal ill-formed part.

Defined results: null and empty text give no ids and the empty text; a special token's string
inside a text gives the special id, as the tokenizer file defines it.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

#: Fixed value of this tokenizer family: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Short units that a worker remembers, in each of two generations, and their longest.
CACHE_ENTRIES = 500_000
CACHED_CHARS = 48
ID_BITS, ID_MASK, NEVER = 24, (1 << 24) - 1, 1 << 62


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeList:
    """Vocabulary and merges of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.token_bytes = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: s.encode() for s, i in self.specials.items()}
        self.byte_ids = [0] * 256
        for t, i in vocab.items():
            if len(t) == 1:
                self.byte_ids[alphabet[t]] = i
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.codes = {p: rank << ID_BITS | new for p, (rank, new) in self.merges.items()}
        self.longest = max(map(len, self.token_bytes.values()))
        self.lookahead = self.sufficient_lookahead()
        self.window = 2 * self.lookahead + self.longest
        self.pattern = regex.compile(PATTERN)
        self.special_pattern = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
            if self.specials else None)

    def sufficient_lookahead(self) -> int:
        """Longest chain of boundary moves, in bytes (see the module text)."""
        left_of: dict[int, int] = {}
        reach: dict[int, int] = {}  # by left part: longest chain that ends with a merge of it so far
        longest = 0
        for (x, y), (_, new) in self.merges.items():  # in rank order
            best, z = 0, y
            while True:
                best = max(best, reach.get(z, 0))
                if z not in left_of:
                    break
                z = left_of[z]
            chain = best + len(self.token_bytes[x])
            reach[x] = max(reach.get(x, 0), chain)
            left_of.setdefault(new, x)
            longest = max(longest, chain)
        return longest

    # ------------------------------------------------------------- merging
    def merge_all(self, data: bytes) -> list[int]:
        """Apply the merges to all of ``data``, lowest rank first, leftmost first."""
        byte_ids = self.byte_ids
        ids = [byte_ids[b] for b in data]
        if len(ids) > 64:
            return self._merge_queued(ids)
        codes = self.codes
        found = [codes.get(p, NEVER) for p in zip(ids, ids[1:])]
        while found:
            low = min(found)
            if low == NEVER:
                break
            at = found.index(low)
            ids[at] = low & ID_MASK
            del ids[at + 1], found[at]
            if at:
                found[at - 1] = codes.get((ids[at - 1], ids[at]), NEVER)
            if at < len(found):
                found[at] = codes.get((ids[at], ids[at + 1]), NEVER)
        return ids

    def _merge_queued(self, ids: list[int]) -> list[int]:
        """The same with a queue of pairs, for long inputs."""
        n, merges = len(ids), self.merges
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        queue = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)

        def push(i: int, j: int) -> None:
            if i >= 0 and j < n and (m := merges.get((ids[i], ids[j]))):
                heapq.heappush(queue, (m[0], i, ids[i], ids[j], m[1]))

        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(before[i], i)
            push(i, after[i])
        return [t for t in ids if t >= 0]

    def encode_pretoken(self, data: bytes) -> Iterator[int]:
        """Ids of one pre-token; holds at most ``window`` bytes in merges at a time."""
        at = 0
        while len(data) - at > self.window:
            end = at
            for t in self.merge_all(data[at:at + self.window]):
                if end + len(self.token_bytes[t]) > at + self.window - self.lookahead:
                    break
                end += len(self.token_bytes[t])
                yield t
            at = end
        yield from self.merge_all(data[at:])

    def encode(self, text: str) -> Iterator[int]:
        """Ids of a text, emitted as they become stable."""
        parts = self.special_pattern.split(text) if any(s in text for s in self.specials) else [text]
        for part in parts:
            if part in self.specials:
                yield self.specials[part]
            else:
                for m in self.pattern.finditer(part):
                    piece = m.group().encode()
                    yield from self.merge_all(piece) if len(piece) <= self.window else self.encode_pretoken(piece)

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of ids, emitted as characters become complete."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            if piece := state.decode(self.token_bytes.get(i, b"")):
                yield piece
        yield state.decode(b"", final=True)


@lru_cache(maxsize=4)
def merge_list(path: str) -> MergeList:
    return MergeList(path)


def units(text: str) -> list[str]:
    """Cut a text before each space that stands between two characters other than white
    space.  The splitting pattern always breaks there and never looks back, so the ids of
    a text are those of its units, one after the other."""
    out, start, space, solid = [], 0, -1, False
    for part in text.split(" "):
        if part:
            if solid and not part[0].isspace():
                out.append(text[start:space])
                start = space
            solid = not part[-1].isspace()
        else:
            solid = False
        space += len(part) + 1
    if start < len(text):
        out.append(text[start:])
    return out


class UnitEncoder:
    """Encodes texts by units and remembers the ids of short ones.

    ``encode_many`` gives the ids of each of some strings as bytes of unsigned 32-bit integers.
    Units are looked up by what follows their space, which ``str.split`` gives; a text with
    other white space beside its spaces goes through ``units``.  What is remembered is the
    current generation and the one before it, which is dropped when the current one is full.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]]):
        self.encode_many = encode_many
        self.after_space: dict[str, bytes] = {}
        self.whole: dict[str, bytes] = {}
        self.older: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (null: empty)."""
        if len(self.after_space) + len(self.whole) >= CACHE_ENTRIES:
            self.older = (self.after_space, self.whole)
            self.after_space, self.whole = {}, {}
        after_space, whole = self.after_space, self.whole
        parts_older, whole_older = self.older
        plans, ask_parts, ask_whole = [], {}, {}
        for text in texts.to_pylist():
            first, *parts = (text or "").split(" ")
            plain = not parts or bool(first) and not first[-1].isspace()
            found = list(map(after_space.get, parts)) if plain else []
            gaps = []
            i = -1
            for _ in range(found.count(None)):
                i = found.index(None, i + 1)
                p = parts[i]
                if not p or p[0].isspace() or p[-1].isspace():
                    plain = False
                    break
                if (ids := parts_older.get(p)) is not None:
                    after_space[p] = found[i] = ids
                else:
                    ask_parts[p] = None
                    gaps.append((i, p))
            plan = [first] if plain else units(text)
            for u in plan:
                if u not in whole:
                    if (ids := whole_older.get(u)) is not None:
                        whole[u] = ids
                    else:
                        ask_whole[u] = None
            plans.append((plan, found, gaps) if plain else (plan, [], []))
        asked = self.encode_many([*(" " + p for p in ask_parts), *ask_whole])
        after_space |= zip(ask_parts, asked)
        whole |= zip(ask_whole, asked[len(ask_parts):])
        out = []
        for plan, found, gaps in plans:
            for i, p in gaps:
                found[i] = after_space[p]
            out.append(np.frombuffer(b"".join([*map(whole.__getitem__, plan), *found]), np.uint32))
        for known, new in ((after_space, ask_parts), (whole, ask_whole)):
            for u in new:
                if len(u) > CACHED_CHARS:
                    del known[u]
        return out


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        merges = merge_list(path)
        _ENCODERS[path] = UnitEncoder(lambda strings: [array("I", merges.encode(u)).tobytes() for u in strings])
    return _ENCODERS[path]


def decoded_bytes(merges: MergeList, ids: np.ndarray, chunk: int = 1 << 16) -> Iterator[bytes]:
    """UTF-8 of the decoded text, a chunk of ids at a time."""
    state, table = codecs.getincrementaldecoder("utf-8")("replace"), merges.token_bytes
    for at in range(0, len(ids), chunk):
        yield state.decode(b"".join([table.get(i, b"") for i in ids[at:at + chunk].tolist()])).encode()
    yield state.decode(b"", final=True).encode()


def encode_documents(docs: DataFrame, tokenizer: str, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:
    """``keep`` columns and ``ids`` (array of int) per document; map-only, one row at a time."""
    def run(batches):
        enc = encoder(tokenizer)
        for b in batches:
            ids = [x.astype(np.int32) for x in enc(b.column(len(keep)))]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), pa.ListArray.from_arrays(ends, pa.array(flat))],
                [*keep, "ids"])

    schema = docs.select(*keep).schema.add("ids", ArrayType(IntegerType()))
    return docs.select(*keep, docs[text].alias("_text")).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, tokenizer: str, keep: list[str] = ["doc_id"], ids: str = "ids") -> DataFrame:
    """``keep`` columns and the decoded ``text`` per row of ids (null ids: empty)."""
    def run(batches):
        merges = merge_list(tokenizer)
        for b in batches:
            texts = [b"".join(decoded_bytes(merges, np.asarray(x or [], np.uint32))).decode()
                     for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), pa.array(texts, pa.string())], [*keep, "text"])

    schema = encoded.select(*keep).schema.add("text", "string")
    return encoded.select(*keep, encoded[ids].alias("_ids")).mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, tokenizer: str, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:
    """``keep``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` per document, encoded and decoded
    in one pass, so that ids need not leave the task."""
    def run(batches):
        enc, merges = encoder(tokenizer), merge_list(tokenizer)
        decimal = {i: str(i) for i in merges.token_bytes}
        for b in batches:
            n, coded, decoded = [], [], []
            for ids in enc(b.column(len(keep))):
                n.append(len(ids))
                coded.append(hashlib.sha256(",".join([decimal[i] for i in ids.tolist()]).encode()).hexdigest())
                digest = hashlib.sha256()
                for piece in decoded_bytes(merges, ids):
                    digest.update(piece)
                decoded.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), pa.array(n, pa.int64()), pa.array(coded, pa.string()),
                 pa.array(decoded, pa.string())], [*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = docs.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string") \
        .add("decoded_sha256", "string")
    return docs.select(*keep, docs[text].alias("_text")).mapInArrow(run, schema)
