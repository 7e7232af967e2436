"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line of the text) is hashed to a wide vector; a text's fingerprint is the sum
of its paragraphs' vectors, each lane modulo 2**32.  So the order of paragraphs does not
matter, equal texts have equal fingerprints, and a paragraph can be added to or taken from a
fingerprint without the rest of the text (``add``, ``remove``).  The lanes of a paragraph:

* 8 *identity lanes*: uniform 32-bit values, from four seeded 64-bit hashes of the paragraph;
* 1 lane that counts its features, and 64 *likeness lanes*: lane j counts the features whose
  hash has bit j set.  A feature is a word with the word after it (or the paragraph's end).
  Twice a count less the number of features is a sum of random signs, so the cosine of two
  texts' sums estimates how much of their word pairs they share, with a standard error of
  about 1/8 for unrelated texts.

Everything is built-in column expressions on one row: no shuffle, no Python.

Defined results: null text is the empty text, which is one empty paragraph; texts without
features have likeness 1 to texts with the same fingerprint and 0 to any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

IDENTITY, LIKENESS = 8, 64
LANES = IDENTITY + 1 + LIKENESS
MASK = 0xFFFFFFFF
# Bits j, j + 8, ..., j + 56 of a hash are eight 8-bit counters of one long; a chunk of
# features is short enough that none of them carries.
EIGHT = 0x0101010101010101
CHUNK = 127


def _sum(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + term(x))


def _shifted(value: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, bits)


def _chunks(values: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(values)), F.lit(CHUNK)),
                       lambda at: F.slice(values, at, CHUNK))


def features(paragraphs: Column) -> Column:
    """64-bit hashes of every word with its next word, paragraph by paragraph."""
    def of(paragraph: Column) -> Column:
        words = F.array(F.regexp_extract_all(paragraph, F.lit(WORD), F.lit(0)))
        return F.element_at(F.transform(words, lambda w: F.transform(
            F.arrays_zip(w.alias("a"), F.slice(w, 2, F.greatest(F.size(w), F.lit(1))).alias("b")),
            lambda p: F.xxhash64(p["a"], p["b"]))), 1)

    return F.flatten(F.transform(paragraphs, of))


def paragraphs_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body's lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _likeness_lanes(hashes: Column) -> Column:
    def counters(chunks: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.transform(chunks, lambda chunk: _sum(
            chunk, lambda h: _shifted(h, j).bitwiseAND(F.lit(EIGHT)))))

    def lanes(c: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(LIKENESS - 1)), lambda i: _sum(
            F.element_at(c, i % 8 + 1), lambda x: _shifted(x, i - i % 8).bitwiseAND(F.lit(0xFF))).bitwiseAND(F.lit(MASK)))

    return _let(_let(_chunks(hashes), counters), lanes)


def _identity_lanes(paragraphs: Column) -> Column:
    hashes = F.transform(paragraphs, lambda p: F.array(*[F.xxhash64(F.lit(s), p) for s in range(IDENTITY // 2)]))
    return _let(hashes, lambda of: F.transform(F.sequence(F.lit(0), F.lit(IDENTITY - 1)), lambda i: _sum(
        of, lambda h: _shifted(F.element_at(h, F.floor(i / 2).cast("int") + 1), 32 * (i % 2))
        .bitwiseAND(F.lit(MASK))).bitwiseAND(F.lit(MASK))))


def with_fingerprint(df: DataFrame, name: str, text: str) -> DataFrame:
    """``df`` with a fingerprint of column ``text``: an array of ``LANES`` longs below 2**32."""
    def of(p: Column) -> Column:
        return _let(features(p), lambda f: F.concat(
            _identity_lanes(p), F.array(F.size(f).cast("long").bitwiseAND(F.lit(MASK))), _likeness_lanes(f)))

    return df.withColumn(name, _let(paragraphs_of(F.col(text)), of))


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MASK)))


def remove(a: Column, b: Column) -> Column:
    """Fingerprint of ``a``'s paragraphs without ``b``'s."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MASK)))


def text_form(fingerprint: Column) -> Column:
    """The lanes as hex digits, 8 a lane."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def _signs(fingerprint: Column) -> Column:
    n = F.element_at(fingerprint, IDENTITY + 1)
    return F.transform(F.slice(fingerprint, IDENTITY + 2, LIKENESS), lambda c: (2 * c - n).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common word pairs, 0 to 1; 1 if the fingerprints are equal."""
    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)

    sa, sb = _signs(a), _signs(b)
    both = total(F.zip_with(sa, sb, lambda x, y: x * y))
    norms = total(F.zip_with(sa, sb, lambda x, y: x * x + y * y))
    value = F.when(norms > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * both / norms))).otherwise(0.0)
    return F.when(a == b, F.lit(1.0)).otherwise(value)
