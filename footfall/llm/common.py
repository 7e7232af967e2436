"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sinks import scratch_table_path
from ..session import ship_package

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows a Python task holds at once; texts are a few KB, some are a hundred times that.
ARROW_ROWS = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def prepare(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Ship the package to Python workers and bound the rows of an Arrow batch, so that long
    texts fit a worker."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: Spark deletes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Inside, what a query has shuffled is deleted when it has ended."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read back (cuts lineage).

    What the write has shuffled is deleted when it has ended, so a job takes the disk of its largest step
    rather than of their sum; a lost executor during the write is recovered from them as ever.
    """
    spark = df.sparkSession
    path = scratch_table_path(spark, name)
    with shuffles_deleted(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {posixpath.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def any_columns(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage``, which returns the columns of its first table, for tables with columns of any names.

    Columns other than ``doc_id``, ``text`` and ``source`` get other names inside, so that none clashes with a
    helper column, and have their own again in the result.
    """
    @wraps(stage)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        inside = [n if n in ("doc_id", "text", "source") else f"_other{i}" for i, n in enumerate(docs.columns)]
        return stage(docs.toDF(*inside), *args, **kwargs).toDF(*docs.columns)
    return run


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, one text at a time (null: empty)."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""
