"""Chat formatting in budgeted windows.

Windows are filled greedily: a window shows the conversation's system turn (if its first turn is
one), the latest whole turns before its own whose tokens fit ``history``, repeated, then its own
turns, as many as the budget leaves room for; the next window starts at the first turn left.  A
turn's tokens are those of its formatted text by the tokenizer, each turn encoded by itself.  The
history gives way to the first own turn; an own turn that does not fit beside the system turn has
a window alone, and only a turn that is longer than the budget by itself makes a window longer.
The loss mask covers the assistant texts of its own turns only; system, repeated and other
turns are masked.

Where the next window starts depends on where this one does, not on the windows before.  So turns
are dealt to blocks of ``BLOCK`` places (with the turns that a window may reach beyond them, as
numbers without text); each block finds where windows that enter it leave it, the blocks of a
conversation are walked in order, a row per block, and each block then lists its windows.  Places
are sums per range of ``TURN_RANGE`` turn numbers, prefix sums over ranges and row numbers inside
a range.  So one conversation with very many turns is many tasks, but for that walk; windows are
built from sorted rows, one at a time.

Template: ``<|turn|>role<|text|>text<|end|>`` per turn.  A control string inside a role or
text gets one backslash after its first character (one more if it has some already); reading
takes one away, so every text comes back.

Defined results: null text or role is empty; turns are ordered by number (null first), then
role, then text; equal rows are separate turns; a null ``conv_id`` is a conversation of its
own; an empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import bpe
from .common import written

BUDGET, HISTORY = 1024, 192
TURN_RANGE, BLOCK = 256, 4096
TOKENIZER = "byte_bpe_50k.json"
#: This template's marks, and those of common chat templates.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = [TURN, TEXT, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
           "<<SYS>>", "<</SYS>>"]
_CONTROL = "|".join(f"{re.escape(c[0])}(?P<b{i}>\\\\*){re.escape(c[1:])}" for i, c in enumerate(CONTROL))
_FIND = re.compile(_CONTROL)
_PLAIN = re.compile("|".join(map(re.escape, CONTROL)))
SEGMENTS = "array<struct<turn: long, start: int, length: int, repeated: boolean, loss: boolean>>"


def escape(text: str) -> str:
    return _FIND.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text)


def unescape(text: str) -> str:
    return _FIND.sub(lambda m: m.group()[0] + m.group()[2:] if m.group()[1] == "\\" else m.group(), text)


def formatted_turn(role: str, text: str) -> str:
    return f"{TURN}{escape(role)}{TEXT}{escape(text)}{END}"


def _counted(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` (role and text last) with ``_n``, the tokens of the formatted turn."""
    def run(batches):
        encode = bpe.encoder(tokenizer)
        for b in batches:
            turns = pa.array(map(formatted_turn, b.column("role").to_pylist(), b.column("text").to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([len(x) for x in encode(turns)], pa.int64())],
                                             [*b.schema.names, "_n"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{types}, _n long")


def spans(n: np.ndarray, first: int, system: int, budget: int, history: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a window whose own turns start at each of the turns: where its history starts, where its
    own turns end, and whether the system turn fits.  ``n`` are the turns' tokens, ``first`` the
    first turn that may be shown (after the system turn)."""
    sums = np.concatenate([[0], np.cumsum(n)])
    beside = n + system <= budget
    room = np.minimum(history, budget - system - n)
    start = np.maximum(np.searchsorted(sums, sums[:-1] - room), first)
    start = np.where(beside, np.minimum(start, np.arange(len(n))), np.arange(len(n)))
    end = np.searchsorted(sums, sums[start] + budget - system, side="right") - 1
    return start, np.where(beside, end, np.arange(len(n)) + 1), beside


def _groups(batches, keys: int):
    """Rows grouped by their first columns, in the order they come."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
    return groupby(rows, key=lambda row: row[:keys])


class _Block:
    """Turns of one block and those around it; places are counted from the first of them."""

    def __init__(self, rows, number: int, budget: int, history: int, block: int):
        places, n, system = (np.array(x, np.int64) for x in zip(*((r[2], r[3], r[4]) for r in rows)))
        self.at, self.system = int(places[0]), int(system[0])
        self.first = max(0, (self.system > 0) - self.at)  # the system turn is nobody's own
        self.own = max(number * block - self.at, self.first)
        self.until = min((number + 1) * block - self.at, len(n))
        if self.system and not self.at:
            n[0] = 0  # counted apart
        self.start, self.end, self.beside = spans(n, self.first, self.system, budget, history)

    def exits(self, most: int) -> list[int]:
        """For each turn at which a window may enter the block, the place of the first after it."""
        out = self.end.copy()
        for i in range(self.until - 1, self.own - 1, -1):
            if out[i] < self.until:
                out[i] = out[out[i]]
        return (out[self.own:min(self.until, self.own + most)] + self.at).tolist()

    def shown(self, entry: int):
        """``window, place, kind`` of the turns shown by the windows that start in the block."""
        i = entry - self.at
        while i < self.until:
            window = 0 if i + self.at == 1 and self.system and self.beside[i] else i + self.at
            if self.system and self.beside[i] and window:
                yield window, 0, 0
            for p in range(self.start[i], self.end[i]):
                yield window, int(p) + self.at, 2 if p >= i else 1
            i = int(self.end[i])


def placed_turns(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                 turn_range: int = TURN_RANGE, block: int = BLOCK, tokenizer: str | None = None) -> DataFrame:
    """A row per turn and window that shows it: ``conv_id, window, place, role, text, kind, _n``.

    ``place`` numbers a conversation's turns; a window is named by the place of its first own
    turn, the one that begins with the system turn by 0.  ``kind`` is 0 system, 1 repeated, 2 own;
    ``_n`` the turn's tokens.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    rows = _counted(rows, tokenizer or public_tokenizers.path(TOKENIZER))
    rows = written(rows.withColumn("_r", F.coalesce(F.floor(F.col("turn") / turn_range), F.lit(-(1 << 40))).cast("long")),
                   "chat-turns")
    sums = rows.groupBy("conv_id", "_r").agg(F.count(F.lit(1)).alias("_k"))
    before = Window.partitionBy("conv_id").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = sums.select(F.col("conv_id").alias("_c"), F.col("_r").alias("_q"),
                          F.coalesce(F.sum("_k").over(before), zero).alias("_turns0"))
    inside = Window.partitionBy("conv_id", "_r").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = written(rows.withColumn("_i", F.count(F.lit(1)).over(inside))
                   .join(offsets, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_r") == F.col("_q")))
                   .select("conv_id", (F.col("_i") + F.col("_turns0")).alias("place"), "role", "text", "_n"), "chat-places")
    is_system = (F.col("place") == 0) & (F.col("role") == "system")
    system = rows.where(is_system).select(F.col("conv_id").alias("_c"), F.col("_n").alias("_sys"))
    numbers = (rows.select("conv_id", "place", "_n").join(system, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
               .withColumn("_sys", F.coalesce("_sys", zero)))
    # A turn has a token at least, so no window reaches further than its budget in turns.
    blocks = F.sequence(F.greatest(zero, F.floor((F.col("place") - budget) / block).cast("long")),
                        F.floor((F.col("place") + history) / block).cast("long"))
    dealt = numbers.select("conv_id", F.explode(blocks).alias("_b"), "place", "_n", "_sys")
    conv = rows.schema["conv_id"].dataType
    id_type, arrow_id = conv.simpleString(), to_arrow_type(conv)

    def out_of(batches):
        for (c, number), group in _groups(batches, 2):
            held = _Block(list(group), number, budget, history, block)
            exits = held.exits(budget)
            if exits:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], arrow_id), pa.array([number], pa.int64()), pa.array([held.own + held.at], pa.int64()),
                     pa.array([held.until + held.at], pa.int64()), pa.array([exits], pa.list_(pa.int64()))],
                    ["conv_id", "_b", "own", "until", "exits"])

    def walked(batches):
        for c, group in _groups(batches, 1):
            at = None
            for _, number, own, until, exits in group:
                at = own if at is None else at
                if at < until:
                    yield pa.RecordBatch.from_arrays([pa.array([c[0]], arrow_id), pa.array([number], pa.int64()),
                                                      pa.array([at], pa.int64())], ["_c", "_q", "entry"])
                    at = exits[at - own]

    def shown(batches):
        for (c, number), group in _groups(batches, 2):
            group = list(group)
            found = list(_Block(group, number, budget, history, block).shown(group[0][5]))
            window, place, kind = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * len(found), arrow_id), pa.array(window, pa.int64()), pa.array(place, pa.int64()),
                 pa.array(kind, pa.int32())], ["_c", "window", "_p", "kind"])

    in_blocks = dealt.repartition("conv_id", "_b").sortWithinPartitions("conv_id", "_b", "place")
    ways = in_blocks.mapInArrow(out_of, f"conv_id {id_type}, _b long, own long, until long, exits array<long>")
    entries = written(ways.repartition("conv_id").sortWithinPartitions("conv_id", "_b")
                      .mapInArrow(walked, f"_c {id_type}, _q long, entry long"), "chat-entries")
    entered = (dealt.join(entries, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_q")))
               .select(*dealt.columns, "entry"))
    pairs = (entered.repartition("conv_id", "_b").sortWithinPartitions("conv_id", "_b", "place")
             .mapInArrow(shown, f"_c {id_type}, window long, _p long, kind int"))
    heads = rows.where(is_system).select("conv_id", zero.alias("window"), "place", "role", "text", F.lit(0).alias("kind"), "_n")
    return (rows.join(pairs, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("place") == F.col("_p")))
            .select("conv_id", "window", "place", "role", "text", "kind", "_n").unionByName(heads))


def windows(conversations: DataFrame, **options) -> DataFrame:
    """``conv_id, window, formatted, segments`` per window.

    A segment is a turn's text in ``formatted`` (code points ``start``, ``length``), its
    number in the conversation, and whether it is repeated and under the loss mask.
    """
    turns = placed_turns(conversations, **options).drop("_n")
    id_type = turns.schema["conv_id"].dataType.simpleString()
    out = f"conv_id {id_type}, window long, formatted string, segments {SEGMENTS}"

    def run(batches):
        key, parts, size, segments, any_own = None, [], 0, [], False

        def close():
            return pa.RecordBatch.from_pylist([{
                "conv_id": key[0], "window": key[1], "formatted": "".join(parts), "segments": segments}], schema)

        schema = pa.schema([("conv_id", arrow_id), ("window", pa.int64()), ("formatted", pa.string()), (
            "segments", pa.list_(pa.struct([("turn", pa.int64()), ("start", pa.int32()), ("length", pa.int32()),
                                            ("repeated", pa.bool_()), ("loss", pa.bool_())])))])
        for b in batches:
            for conv, window, place, role, text, kind in zip(*(c.to_pylist() for c in b.columns)):
                if key != (conv, window):
                    if any_own:
                        yield close()
                    key, parts, size, segments, any_own = (conv, window), [], 0, [], False
                head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
                repeated = kind == 1 or kind == 0 and window > 0
                segments.append({"turn": place, "start": size + len(head), "length": len(body), "repeated": repeated,
                                 "loss": kind == 2 and role == "assistant"})
                parts += [head, body, END]
                size += len(head) + len(body) + len(END)
                any_own |= kind == 2 or kind == 0 and window == 0
        if any_own:
            yield close()

    arrow_id = to_arrow_type(turns.schema["conv_id"].dataType)
    return (turns.repartition("conv_id", "window").sortWithinPartitions("conv_id", "window", "kind", "place")
            .mapInArrow(run, out))


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window, by its marks alone."""
    out = []
    for part in formatted.split(END)[:-1]:
        head, _, body = part.partition(TEXT)
        out.append((unescape(head[len(TURN):]), unescape(body)))
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows hold, read back from their text: one row per conversation.

    ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows``.  Windows
    of a conversation are read in order and hashed as they come, one at a time.
    """
    id_type = formatted.schema["conv_id"].dataType
    out = (f"conv_id {id_type.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
           "loss_sha256 string, formatted_chars long, n_windows long")
    schema = pa.schema([("conv_id", to_arrow_type(id_type)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("n_windows", pa.int64())])

    def run(batches):
        conv, begun, turns, loss, counts = None, False, None, None, None

        def close():
            return {"conv_id": conv, "n_turns": counts[0], "turns_sha256": turns.hexdigest(), "loss_chars": counts[1],
                    "loss_sha256": loss.hexdigest(), "formatted_chars": counts[2], "n_windows": counts[3]}

        for b in batches:
            rows = []
            for c, _, text, segments in zip(*(x.to_pylist() for x in b.columns)):
                if not begun or c != conv:
                    if begun:
                        rows.append(close())
                    conv, begun, turns, loss, counts = c, True, hashlib.sha256(), hashlib.sha256(), [0, 0, 0, 0]
                counts[2] += len(text)
                counts[3] += 1
                for (role, body), s in zip(parse(text), segments, strict=True):
                    if s["repeated"]:
                        continue
                    counts[0] += 1
                    turns.update(f"{role}\n{body}\n".encode())
                    if s["loss"]:
                        masked = unescape(text[s["start"]:s["start"] + s["length"]])
                        counts[1] += len(masked)
                        loss.update(masked.encode())
            yield pa.RecordBatch.from_pylist(rows, schema)
        if begun:
            yield pa.RecordBatch.from_pylist([close()], schema)

    return (formatted.select("conv_id", "window", "formatted", "segments").repartition("conv_id")
            .sortWithinPartitions("conv_id", "window").mapInArrow(run, out))
