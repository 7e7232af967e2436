"""The operators as queries over the given tables (``QUERIES``) and their SQL (``ORACLES``).

The others have no SQL: DuckDB has neither their tokenizers nor their hash keys; ``tests/llm``
holds them against plain Python.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.sinks import scratch_table_path
from . import (alignment, bpe, chat, classifier, fingerprint, hyperminhash, mixing, quality, sigtree, suffixarray,
               suffixtree, tokenbin, trie)
from .common import read, shuffle_partitions, prepare, text_of, written
from .oracles import ORACLES  # noqa: F401  (SQL of the queries that SQL can express)

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as bit-packed token blocks, written and read back."""
    prepare(spark)
    path = scratch_table_path(spark, "token-blocks")
    tokenbin.write_tokens(read(spark, sf_dir, "documents"), tokenizer_path(), path)
    found = tokenbin.read_documents(spark, path, tokenbin.crc32_of)
    return found.withColumnRenamed("digest", "ids_crc32")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    mixed = mixing.mix_documents(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def next_ids(ids: DataFrame) -> DataFrame:
    """``id, none, next_id, next_none``: the next distinct id in descending order (null last;
    after the last: the first).  Ids are sorted in ranges; the only rows that meet in one task
    are one per range."""
    spark = ids.sparkSession
    ordered = (ids.select("id", "none").distinct()
               .repartitionByRange(shuffle_partitions(spark), F.col("none"), F.col("id").desc()))
    ranged = written(ordered.withColumn("range", F.spark_partition_id()), "id-ranges")
    inside = Window.partitionBy("range").orderBy("none", F.col("id").desc())
    rows = ranged.withColumns({"n": F.row_number().over(inside), "next": F.lead(F.struct("id", "none")).over(inside)})
    heads = rows.where("n = 1").select("range", F.struct("id", "none").alias("head"))
    # One row per range: their number is a setting, not the input's size.
    after = F.lead("head").over(Window.orderBy("range"))
    first = F.first("head").over(Window.orderBy("range"))
    heads = heads.select(F.col("range").alias("r"), F.coalesce(after, first).alias("head"))
    return (rows.join(F.broadcast(heads), F.col("range") == F.col("r"))
            .withColumn("next", F.coalesce("next", "head"))
            .select("id", "none", F.col("next.id").alias("next_id"), F.col("next.none").alias("next_none")))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses.

    Of documents with one id, the smallest text is "the next document" of the id before.
    """
    docs = read(spark, sf_dir, "documents")
    base = docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"),
                       text_of().alias("text"))
    lengths = base.groupBy("id", "none").agg(F.floor(F.max(F.length("text")) / 3).cast("int").alias("m"))
    follow = written(next_ids(base).join(lengths, ["id", "none"]), "next-documents")
    by_id = Window.partitionBy("id", "none").orderBy("text")
    rows = base.withColumn("first", F.lag(F.lit(1)).over(by_id).isNull())
    owners = follow.select(F.col("next_id").alias("id"), F.col("next_none").alias("none"), F.col("id").alias("owner"),
                           F.col("none").alias("owner_none"), "m")
    heads = (rows.where("first").join(owners, ["id", "none"])
             .select(F.col("owner").alias("id"), F.col("owner_none").alias("none"),
                     F.expr("substring(text, 1, m)").alias("head")))
    n, cut = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("head", F.lit(1), cut))
    both = (rows.join(heads, ["id", "none"])
            .select("id", "none", "first", "text", n.cast("long").alias("n_chars"), edited.alias("edited")))
    both = both.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    marked = fingerprint.with_fingerprint(both, "f", "text").drop("text")
    marked = fingerprint.with_fingerprint(marked, "e", "edited").drop("edited")
    marked = written(marked, "fingerprints").join(follow.drop("m"), ["id", "none"])
    nexts = marked.where("first").select(F.col("id").alias("next_id"), F.col("none").alias("next_none"),
                                         F.col("f").alias("g"))
    return marked.join(nexts, ["next_id", "next_none"]).select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_chars", "edited_sha256",
        fingerprint.text_form(F.col("f")).alias("fingerprint"),
        fingerprint.text_form(F.col("e")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("f"), F.col("e")).alias("near_edited"),
        fingerprint.likeness(F.col("f"), F.col("g")).alias("near_next"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles overlap by 85 in 100."""
    prepare(spark)
    return hyperminhash.near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that start anywhere else, removed."""
    prepare(spark)
    return suffixarray.dedup_digests(read(spark, sf_dir, "documents"), length=200, first_stays=False)


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 20-word windows that start earlier, removed."""
    prepare(spark)
    return suffixtree.dedup_digests(read(spark, sf_dir, "documents"), length=20, first_stays=True)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded."""
    prepare(spark)
    return bpe.round_trip_digests(read(spark, sf_dir, "documents"), tokenizer_path())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every document and whether it is kept."""
    judged = quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "score")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    vectors, network = classifier.train(docs, read(spark, sf_dir, "labels"))
    return classifier.score(docs, vectors, network)


def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted in windows, written, and read back."""
    prepare(spark)
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", extra), (-7, 1, "assistant", extra)], rows.schema))
    return chat.digests(written(chat.windows(rows), "chat-windows"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of conversations with shared first turns."""
    prepare(spark)
    return trie.shared_trie(read(spark, sf_dir, "conversations"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document."""
    prepare(spark)
    return alignment.align_digests(read(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path(PIECES))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles overlap by 85 in 100."""
    prepare(spark)
    return sigtree.jaccard_components(read(spark, sf_dir, "documents"), width=4, percent=85)


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_blocks, op2_mix_sources, op3_fingerprints, op4_near_duplicates, op5_suffix_array, op6_suffix_tree,
    op7_bpe, op8_quality_rules, op9_quality_classifier, op10_chat_windows, op11_conversation_trie,
    op12_tokenizer_alignment, op13_jaccard_join)} | {"pipeline": _pipeline}
