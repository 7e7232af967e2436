"""What changed between two versions of a table, by hash trees, and recomputing only that.

A version's tree has a leaf per user and day (number of rows and a multiset hash of them), a node per
range of users and day, and a node per day.  Comparing two versions goes down from the days: leaves are
read only below nodes that differ, so equal days cost one row each and rows are never compared.
The tree is written once per version, beside the table, and the earlier version itself is not read again.

The hash of a row set is a sum of row hashes (four lanes mod 2^32, 128 bits), so the order of rows does not
matter, repeated rows count, and a busy user's rows combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from . import dwell

USER_RANGES = 256
LANES = ["h0", "h1", "h2", "h3"]
LEAF, NODE, DAY = ["date_dt", "place", "user_id"], ["date_dt", "place"], ["date_dt"]
HALF = 1 << 32
LEAVES = f"place int, user_id bigint, n bigint, {', '.join(f'{h} bigint' for h in LANES)}, date_dt date"


def _lanes(columns: Sequence[str]) -> list[Column]:
    """Four 32-bit lanes of a row's hash; null tests are hashed too, as a null alone leaves a hash as it is."""
    seen = [x for c in columns for x in (F.col(c), F.col(c).isNull().cast("int"))]
    both = [F.xxhash64(F.lit(salt), *seen) for salt in (1, 2)]
    return [half for h in both for half in (F.pmod(h, F.lit(HALF)), F.pmod(F.shiftright(h, 32), F.lit(HALF)))]


def _summed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], n: Column) -> DataFrame:
    """Per key the rows below and the lane sums of the hashes of ``columns``."""
    rows = df.select(*keys, n.alias("n"), *(x.alias(h) for h, x in zip(LANES, _lanes(columns))))
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.pmod(F.sum(h), F.lit(HALF)).alias(h) for h in LANES))


def write_tree(table: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Write the tree of ``table`` (with ``date_dt`` date, ``user_id`` bigint; null is a value) over ``columns`` (all by default)
    to the folders ``leaves`` (by day), ``nodes`` and ``days`` of ``path``."""
    columns = list(columns or table.columns)
    rows = table.withColumn("place", F.pmod(F.xxhash64("user_id"), F.lit(USER_RANGES)).cast("int"))
    leaves = _summed(rows, LEAF, columns, F.lit(1).cast("long"))
    leaves.sortWithinPartitions("date_dt", "place").write.partitionBy("date_dt").parquet(f"{path}/leaves")
    spark = table.sparkSession
    nodes = _summed(_leaves(spark, path), NODE, [*LEAF, "n", *LANES], F.col("n"))
    nodes.write.parquet(f"{path}/nodes")
    _summed(spark.read.parquet(f"{path}/nodes"), DAY, [*NODE, "n", *LANES], F.col("n")).write.parquet(f"{path}/days")


def _leaves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEAVES).parquet(f"{path}/leaves")


def _differing(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, n_before, n_after`` where the two sides do not agree (0 rows where a side lacks the key)."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.struct(*keys).alias(f"key_{name}"), F.struct("n", *LANES).alias(name))
    met = side(before, "old").join(side(after, "new"), F.col("key_old").eqNullSafe(F.col("key_new")), "full")
    rows = lambda c: F.coalesce(F.col(f"{c}.n"), F.lit(0)).cast("long")
    key = F.coalesce("key_old", "key_new")
    return (met.where(~F.col("old").eqNullSafe(F.col("new")))
            .select(*(key[k].alias(k) for k in keys), rows("old").alias("n_before"), rows("new").alias("n_after")))


def _below(df: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` under the keys ``found``."""
    f = found.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return df.join(f, cond, "left_semi")


def changed_user_days(spark: SparkSession, before: str, after: str) -> DataFrame:
    """``date_dt, user_id, n_before, n_after``: the users and days whose rows differ between two trees."""
    days = _differing(*(spark.read.parquet(f"{p}/days") for p in (before, after)), DAY)
    nodes = _differing(*(_below(spark.read.parquet(f"{p}/nodes"), days, DAY) for p in (before, after)), NODE)
    leaves = _differing(*(_below(_below(_leaves(spark, p), days, DAY), nodes, NODE) for p in (before, after)), LEAF)
    return leaves.select("date_dt", "user_id", "n_before", "n_after")


def refreshed_dwells(dwells: DataFrame, trace: DataFrame, site_cell_table: DataFrame, changed: DataFrame,
                     p: Params = DEFAULT) -> DataFrame:
    """Dwells of the later ``trace``: computed again for the ``changed`` users and days, else taken from
    ``dwells`` of the earlier one.  Equal to all dwells of ``trace`` in the mode ``contained``, whose rules look at
    one user and day; ``as_reference`` matches across users and has to be computed as a whole."""
    keys = changed.select(F.col("date_dt").alias("_d"), F.col("user_id").alias("_u"))
    cond = F.col("date_dt").eqNullSafe(F.col("_d")) & F.col("user_id").eqNullSafe(F.col("_u"))
    again = dwell.dwells_from_events(dwell.events_at_site(trace.join(keys, cond, "left_semi"), site_cell_table), p)
    return dwells.select(*dwell.DWELL_COLUMNS).join(keys, cond, "left_anti").unionByName(again.select(*dwell.DWELL_COLUMNS))
