"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

Every stage takes and returns rows with the columns of ``documents`` (extra columns stay); the
last returns ids of tokens and their number beside ``doc_id`` and ``source``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import bpe, hyperminhash, mixing, quality, suffixarray
from footfall.llm.common import read, prepare, written
from footfall.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, similarity 0.8)."""
    prepare(spark)
    return hyperminhash.keep_first(docs, width=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of strings of 200 bytes or more are cut out of texts."""
    prepare(spark)
    return suffixarray.without_repeats(docs, length=200, first_stays=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_corpus(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    prepare(spark)
    coded = bpe.encode_documents(docs, tokenizer_path(), keep=["doc_id", "source"])
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mix of sources", mix_sources),
    ("token ids", encode),
]

#: DuckDB has neither this tokenizer nor the hashes of the mix: tested by brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
