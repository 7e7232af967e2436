"""Quality rules: base statistics and a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words are hashed n-grams.  Two multinomials over all n-grams of the
corpus are counted: the raw corpus (every document) and the trusted target (every document labelled
good and not toxic).
A document's score is the sum of log-ratios of its n-grams divided by their number plus
``SHRINK`` (so that very short texts stay near the neutral 0).  A fifth of the trusted documents,
by hash, is left out of the counts and sets the threshold:
``median - 2 * (median - 1st percentile)`` of their scores.  Each document, trusted or not, is
kept if its score is at least that.

N-grams are counted and looked up by ``ngrams`` in Arrow batches: as rows of built-in functions they took
four times the input on disk.  Base statistics are column expressions on one row; see ``base_statistics``.

Defined results: null text is the empty text: no words, base failed; rows with the same id and
text get the same result each; without trusted documents no score rejects anything.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ngrams
from .common import WORD, any_columns, prepare, shuffle_partitions, text_of, written

SHRINK = 16
SYMBOLS = r"[#*$%&|<>]"
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5


def words(text: str = "text") -> Column:
    return F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    ``n_repeat_words``: hashes of all 5-word windows, sorted with their places; a window is
    repeated if a neighbour in that order has its hash.  Texts without two equal windows, most
    of them, skip the sort.  The words covered are the sum over repeated windows of the words
    up to the next one, 5 at most.
    """
    w = F.col("_words")
    zipped = F.arrays_zip(*[F.slice(w, i + 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))).alias(f"w{i}")
                            for i in range(WINDOW)])
    docs = docs.withColumn("_words", words(text))
    docs = docs.withColumn("_windows", F.when(F.size("_words") > WINDOW, F.transform(zipped, lambda z: F.xxhash64(
        *[z[f"w{i}"] for i in range(WINDOW)]))).otherwise(F.array().cast("array<long>")))
    h = F.col("_windows")
    placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    docs = docs.withColumn("_placed", F.when(F.size(F.array_distinct(h)) < F.size(h), placed))
    p = F.col("_placed")
    repeated = F.filter(p, lambda x, i: (x.h == F.get(p, i - 1).h) | (x.h == F.get(p, i + 1).h))
    docs = docs.withColumn("_at", F.sort_array(F.transform(repeated, lambda x: x.i)))
    at = F.col("_at")
    covered = F.aggregate(
        F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda s, x: s + x)
    t = text_of(text)
    lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike(WORD))
    docs = docs.withColumn("_lines", lines)
    docs = docs.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long")})
    return (docs.withColumn("base_failed", (F.col("n_words") < 10)
                            | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
            .drop("_words", "_windows", "_placed", "_at", "_lines"))


def row_keys(text: str = "text") -> dict[str, Column]:
    """A 128-bit key of a document's id and text."""
    return {"_k1": F.xxhash64("doc_id", text), "_k2": F.xxhash64(F.lit(1), F.length(text), text, "doc_id")}


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the trusted documents, all of them, and whether they only calibrate."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return (good.select(F.col("doc_id").alias("_id")).distinct()
            .withColumn("_calibrates", F.pmod(F.xxhash64(F.lit(5), "_id"), F.lit(5)) == 0))


def flagged(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Keys, text and ``flags`` of ``docs``: whether n-grams count for the trusted target, or calibrate."""
    flags = F.when(F.col("_calibrates"), F.lit(ngrams.CALIBRATES)).when(~F.col("_calibrates"), F.lit(ngrams.TARGET)).otherwise(0)
    return (docs.select("doc_id", "text", *[c.alias(n) for n, c in row_keys().items()])
            .join(trusted, F.col("doc_id") == F.col("_id"), "left")
            .select("_k1", "_k2", flags.cast("int").alias("flags"), "text"))


def scores(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``_k1``, ``_k2``, ``_calibrates``, ``score`` for every document with a word, once for equal rows."""
    sums, constant = ngrams.log_ratio_sums(flagged(docs, trusted))
    score = (F.col("_s") + F.col("_n") * F.lit(constant)) / (F.col("_n") + SHRINK)
    return (sums.withColumn("score", score).groupBy("_k1", "_k2")
            .agg((F.max("flags") == ngrams.CALIBRATES).alias("_calibrates"), F.max("score").alias("score")))


def quantiles(values: DataFrame, column: str, shares: list[float]) -> list[float] | None:
    """Exact quantiles, interpolated as ``percentile`` does; values are sorted in ranges, and what
    meets on the driver is a row per range and two per quantile."""
    ranged = (values.select(F.col(column).alias("v")).where("v is not null")
              .repartitionByRange(shuffle_partitions(values.sparkSession), "v"))
    ranged = written(ranged.withColumn("range", F.spark_partition_id()), "value-ranges")
    starts, n = [], 0
    for r in sorted(ranged.groupBy("range").count().collect()):
        starts.append((r["range"], n, n + r["count"]))
        n += r["count"]
    if not n:
        return None
    at = [(n - 1) * share for share in shares]
    ranks = sorted({f(x) for x in at for f in (math.floor, math.ceil)})
    wanted = {(i, k - start): k for k in ranks for i, start, end in starts if start <= k < end}
    rows = ranged.withColumn("i", F.row_number().over(Window.partitionBy("range").orderBy("v")) - 1)
    picked = F.lit(False)
    for i, place in wanted:
        picked = picked | ((F.col("range") == i) & (F.col("i") == place))
    value = {wanted[r["range"], r["i"]]: r["v"] for r in rows.where(picked).collect()}
    return [value[math.floor(x)] + (x - math.floor(x)) * (value[math.ceil(x)] - value[math.floor(x)]) for x in at]


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``_k1``, ``_k2`` (``row_keys``), ``score``, ``good``: whether the method keeps the text."""
    prepare(docs.sparkSession)
    found = written(scores(docs, written(trusted_ids(labels), "trusted")), "quality-scores")
    held = found.where("_calibrates")
    q = quantiles(held, "score", [0.5, 0.01])
    threshold = float("-inf") if q is None else q[0] - 2 * (q[0] - q[1])
    return found.select("_k1", "_k2", "score", (F.col("score") >= F.lit(threshold)).alias("good"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` (in any columns): base statistics, ``score`` and ``kept``; no text."""
    rows = base_statistics(docs.select("doc_id", "text").withColumns(row_keys())).drop("text")
    joined = rows.join(verdicts(docs, labels), ["_k1", "_k2"], "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce("good", F.lit(True)))


@any_columns
def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    rejected = judge(docs, labels).where(~F.col("kept")).select("_k1", "_k2").distinct()
    return docs.withColumns(row_keys()).join(rejected, ["_k1", "_k2"], "left_anti").select(*docs.columns)
