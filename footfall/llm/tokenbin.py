"""Token ids as fixed-width bit-packed blocks.

``write_tokens`` encodes documents with the ``tokenizers`` library and writes their ids in
ascending ``doc_id`` order as a folder of Parquet shards whose rows are *blocks*:

=============  =====================================================================
shard          number of the range of document ids (ascending)
block          number of the block in its shard (ascending)
start          ids of all earlier blocks of the shard
bits           width of an id: the bits of the vocabulary's largest id
docs           list of (doc_id, offset in the block, n_tokens), documents whole, in order
payload        ids packed ``bits`` wide, little-endian in 64-bit words, 64 ids in ``bits`` words
=============  =====================================================================

A block closes with the document that fills it, so a document is one slice of one block:
``unpack(payload, bits, offset, n)`` reads any run of ids without the ids before it, with
vectorised shifts.  A block's first id in the whole corpus is its shard's start (a prefix sum
over one total per shard) plus ``start``.

Defined results: null text is the empty text (the end id only); rows with the same ``doc_id``
are ordered by text, a null ``doc_id`` comes first; an empty table gives no blocks.
"""

from __future__ import annotations

import math
import os
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import UnitEncoder, byte_alphabet, merge_list
from .common import shuffle_partitions

BLOCK_IDS = 1 << 15
SCHEMA = ("shard int, block int, start long, bits int, "
          "docs array<struct<doc_id: {id}, offset: int, n_tokens: int>>, payload binary")


def width(vocabulary: int) -> int:
    """Fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive ``bits``-wide fields; the last group of 64 is filled with zeros."""
    groups = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    groups.reshape(-1)[:len(ids)] = ids
    words = np.zeros((len(groups), bits), "<u8")
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= groups[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= groups[:, j] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(payload: bytes, bits: int, offset: int, n: int) -> np.ndarray:
    """``n`` ids from position ``offset``; reads only the groups that hold them."""
    first, last = offset // 64, -(-(offset + n) // 64)
    words = np.frombuffer(payload, "<u8", (last - first) * bits, first * bits * 8).reshape(-1, bits)
    mask, ids = np.uint64((1 << bits) - 1), np.empty((last - first, 64), np.uint32)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[:, word + 1] << np.uint64(64 - shift)
        ids[:, j] = value & mask
    return ids.reshape(-1)[offset - 64 * first:offset - 64 * first + n]


_ENCODERS: dict[str, tuple[UnitEncoder, int]] = {}


def library_encoder(path: str) -> tuple[UnitEncoder, int]:
    """The worker's encoder by the ``tokenizers`` library, and the size of its vocabulary."""
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        merges = merge_list(path)
        shown = {byte: char for char, byte in byte_alphabet().items()}
        pattern, model, specials = merges.pattern, tokenizer.model.tokenize, list(merges.specials)
        space = shown[ord(" ")]

        def encode_one(unit: str) -> bytes:
            """The library's merges for each pre-token; the whole library for special strings.  Letters, with a space
            before them or not, are one pre-token."""
            for s in specials:
                if s in unit:
                    return array("I", tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()
            word = unit[1:] if unit[:1] == " " else unit
            if not word.isalpha():
                return array("I", [t.id for p in pattern.findall(unit) for t in model(
                    p.encode().decode("latin-1").translate(shown))]).tobytes()
            if word.isascii():
                return array("I", [t.id for t in model(word if word is unit else space + word)]).tobytes()
            return array("I", [t.id for t in model(unit.encode().decode("latin-1").translate(shown))]).tobytes()

        def encode_many(strings: list[str]) -> list[bytes]:
            return list(map(encode_one, strings))

        _ENCODERS[path] = UnitEncoder(encode_many), tokenizer.get_vocab_size(with_added_tokens=True)
    return _ENCODERS[path]


def token_blocks(docs: DataFrame, tokenizer: str, end_id: int | None = 0, block_ids: int = BLOCK_IDS,
                 shards: int | None = None) -> DataFrame:
    """Blocks of the ids of ``docs`` (``doc_id``, ``text``), one shard per range of ``doc_id``."""
    spark = docs.sparkSession
    shards = shards or shuffle_partitions(spark)

    def run(batches):
        enc, vocabulary = library_encoder(tokenizer)
        bits = width(vocabulary)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        held, index, size = [], [], 0

        def close():
            nonlocal block, start, held, index, size
            record = pa.RecordBatch.from_pylist([{
                "shard": shard, "block": block, "start": start, "bits": bits, "docs": index,
                "payload": pack(np.concatenate(held), bits)}], schema)
            block, start, held, index, size = block + 1, start + size, [], [], 0
            return record

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), enc(b.column(1))):
                index.append({"doc_id": doc_id, "offset": size, "n_tokens": len(ids) + len(end)})
                held += [ids, end]
                size += len(ids) + len(end)
                if size >= block_ids:
                    yield close()
        if index:
            yield close()

    out = SCHEMA.format(id=docs.schema["doc_id"].dataType.simpleString())
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(spark.createDataFrame([], out).schema)
    return (docs.select("doc_id", "text").repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
            .mapInArrow(run, out))


def write_tokens(docs: DataFrame, tokenizer: str, path: str, **options) -> None:
    """Write ``token_blocks`` under ``path`` (a shared folder)."""
    token_blocks(docs, tokenizer, **options).write.option("compression", "none").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``first``, the ids of all blocks before (whole corpus)."""
    blocks = spark.read.parquet(path)
    # One row per shard: their number is set when writing, whatever the input's size.
    totals = blocks.groupBy("shard").agg(
        F.max(F.col("start") + F.aggregate("docs", F.lit(0).cast("long"), lambda n, d: n + d.n_tokens)).alias("_n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("_n").over(order), F.lit(0).cast("long")).alias("_before"))
    return (blocks.join(F.broadcast(starts), "shard")
            .withColumn("first", F.col("_before") + F.col("start")).drop("_before"))


def read_documents(spark: SparkSession, path: str, digest: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens`` and its ``ids`` (or ``digest`` of them, a long)."""
    blocks = read_blocks(spark, path)
    id_type = blocks.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    last = "digest long" if digest else "ids array<int>"
    out = f"doc_id {id_type}, start long, n_tokens long, {last}"
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(spark.createDataFrame([], out).schema)

    def run(batches):
        for b in batches:
            for block in b.to_pylist():
                rows, size = [], sum(d["n_tokens"] for d in block["docs"])
                every = unpack(block["payload"], block["bits"], 0, size)
                for d in block["docs"]:
                    ids = every[d["offset"]:d["offset"] + d["n_tokens"]]
                    rows.append({"doc_id": d["doc_id"], "start": block["first"] + d["offset"],
                                 "n_tokens": d["n_tokens"],
                                 last.split()[0]: digest(ids) if digest else ids.astype(np.int32)})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return blocks.select("first", "bits", "docs", "payload").mapInArrow(run, out)


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def packed_bytes(n_ids: int, bits: int) -> int:
    return math.ceil(n_ids / 64) * bits * 8
