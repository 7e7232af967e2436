"""Mixing sources to target weights.

Each row gets a hash-random key; a source's rows are sorted by it in ranges of about
``ROWS_PER_RANGE`` rows.  Prefix sums of sizes over a source (sums per range, prefix sums over
ranges, prefix sums inside a range) place every row on the source's line of words, and the
budget cuts that line: whole epochs first, then the words up to the exact rest.  A source with
any share of the rows is as many tasks as it has ranges.

Defined results: null text has size 0 and takes nothing; a null source is a source of its own,
last in order; rows with equal columns are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, any_columns, text_of, written

ROWS_PER_RANGE = 4_000
RANGES = 1 << 40  # values of a key


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def sums_before(df: DataFrame, order: list, columns: list[str], name: str) -> DataFrame:
    """``df`` with ``_before<column>``: the sum of each column over the rows before, in a total ``order``.

    Rows are sorted in ranges, written once so that the ranges stay; only a row per range is summed in one task.
    """
    ranged = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    line = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (ranged.groupBy("_part").agg(*(F.sum(c).alias(c) for c in columns))
             .select(F.col("_part").alias("_p"), *(F.coalesce(F.sum(c).over(line), F.lit(0)).alias(f"_all{c}") for c in columns)))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumns({f"_in{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in columns})
            .join(parts, F.col("_part") == F.col("_p"))
            .select(*df.columns, *((F.col(f"_all{c}") + F.col(f"_in{c}")).alias(f"_before{c}") for c in columns)))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0,
            most: float = 3.0) -> DataFrame:
    """Words to take per source: ``share`` of all sizes in proportion to weights, at most
    ``most`` times a source's own size, the excess dealt to the others by weight.

    ``sizes`` has one row per source (``source``, ``source_size``, ``n_rows``); sources by
    code point, null last, weigh ``weights`` in turn.  The result is the level ``v`` at which
    ``sum(min(most * size, weight * v))`` is the total: sources reach their cap in order of
    ``cap / weight``, so prefix sums over that order give ``v``.  Numbers and prefix sums are taken by
    ranges of sources, so a source may be a host or a URL; the driver gets the total and the level.
    """
    order = ["source", "source_size", "n_rows"]
    numbered = sums_before(sizes.withColumn("_one", F.lit(1)), [F.col("source").asc_nulls_last()], ["_one"], "mix-sources")
    rows = (numbered.withColumnRenamed("_before_one", "_n")
            .withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (F.col("_n") % len(weights) + 1).cast("int")))
            .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
            .select(*order, "_n", "_weight", "_cap", (F.col("_cap") / F.col("_weight")).alias("_level")))
    rows = sums_before(rows, ["_level", "_n"], ["_cap", "_weight"], "mix-levels")
    whole = rows.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    v = ((F.lit(float(whole.size or 0) * share) - F.col("_before_cap"))
         / (F.lit(whole.weight or 0.0) - F.col("_before_weight")))
    # The level is that of the first source, in this order, which does not reach its cap.
    first = (rows.withColumn("_v", v).where(F.col("_v") <= F.col("_level"))
             .agg(F.min(F.struct("_level", "_n", "_v")).alias("at")).first().at)
    if first is None:
        target = F.col("_cap")
    else:
        capped = F.struct("_level", "_n") < F.struct(F.lit(first._level).alias("_level"), F.lit(first._n).alias("_n"))
        target = F.when(capped, F.col("_cap")).otherwise(F.col("_weight") * F.lit(first._v))
    return rows.select(*order, target.alias("target"))


def mix(rows: DataFrame, keep: list[str], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0,
        most: float = 3.0, seed: int = 17, whole: bool = False,
        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``keep``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` per row of ``rows``.

    ``rows`` has ``keep`` (the columns that identify a row), ``source`` and ``size``.  ``taken``
    counts words over all epochs; the row at the cut gives the words that are left, or, with
    ``whole``, all or none of its words, whichever is nearer.
    """
    rows = written(
        rows.select(*keep, "source", F.col("size").cast("long").alias("size"),
                    F.pmod(F.xxhash64(F.lit(seed), *keep, "size"), F.lit(RANGES)).alias("_key")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    budget = targets(sizes, weights, share, most).withColumnsRenamed({"source": "_source"})
    rows = rows.join(budget, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    n_ranges = F.ceil(F.col("n_rows") / rows_per_range)
    rows = rows.withColumn("_range", F.floor(F.col("_key") * n_ranges / F.lit(RANGES)).cast("long"))
    sums = rows.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    line = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("_source"), F.col("_range").alias("_r"),
                          F.coalesce(F.sum("_sum").over(line), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("source", "_range").orderBy("_key", *keep).rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r"))))
    words = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    rest = words - epochs * F.col("source_size") - F.col("_offset") - F.col("_inside")
    last = (F.when(2 * rest >= F.col("size"), F.col("size")).otherwise(0) if whole
            else F.greatest(F.lit(0), F.least(rest, F.col("size"))))
    return placed.select(*keep, "source", "size", "source_size", "target",
                         (epochs * F.col("size") + last).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``mix`` over documents (``doc_id``, ``source``, ``text``) by their words."""
    return mix(docs.select("doc_id", "source", word_count().alias("size")), ["doc_id"], **options)


@any_columns
def mixed_corpus(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, whole documents only.

    Rows are matched by a 128-bit hash of ``doc_id``, ``source`` and ``text``; rows equal in
    these share what is taken of them.
    """
    ids = {"_k1": F.xxhash64("text", "doc_id", "source"),
           "_k2": F.xxhash64(F.lit(1), "source", "doc_id", F.length("text"), "text")}
    # Texts without a word are never taken: they would be one group if their ids are null.
    marked = docs.where(text_of().rlike(WORD)).withColumns(ids)
    taken = mix(docs.withColumns(ids).select("_k1", "_k2", "source", word_count().alias("size")), ["_k1", "_k2"],
                whole=True, **options)
    taken = (taken.where(F.col("size") > 0).groupBy("_k1", "_k2")
             .agg(F.sum(F.floor(F.col("taken") / F.col("size")).cast("long")).alias("_copies"),
                  F.count(F.lit(1)).alias("_rows")).where("_copies > 0"))
    same = Window.partitionBy("_k1", "_k2").orderBy("_k1")
    upto = [F.floor((F.col("_i") + i) * F.col("_copies") / F.col("_rows")).cast("int") for i in (0, 1)]
    return (marked.withColumn("_i", F.row_number().over(same) - 1).join(taken, ["_k1", "_k2"])
            .withColumn("_n", upto[1] - upto[0]).where("_n > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*docs.columns))
