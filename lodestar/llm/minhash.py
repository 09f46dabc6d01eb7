"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every shingle of five words is hashed once. The hash's upper bits choose one
of 256 bins, the rest is its value, and each bin keeps its least value. An
empty bin takes the value of another bin by optimal densification: it tries
bins in an order that depends on the empty bin alone (a full cycle with a
random start and an odd random step) and takes the first that is not empty,
so two documents agree on a filled bin as often as they are alike. Of each
bin the four lowest bits are kept, 1,024 bits in all, written as hexadecimal
digits. Unlike bins agree in four bits with chance 1/16, which the likeness
estimate takes out: (share of equal digits - 1/16) / (1 - 1/16), at least 0.

All of it is one projection per document: split, transform, sort_array and
filter. The bins' minima come from one sort of the hashes together with an
upper bound per bin, so nothing is exploded and nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import NOT_WORD, free_name, shuffle_width

SHINGLE = 5
BINS = 256
DIGIT_BITS = 4
TRIES = 8
_SHIFT = 56  # 64 - log2(BINS): the bin is the signed upper byte


def _longs(values) -> Column:
    """A literal array of longs (one expression, not one per entry)."""
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<long>")


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """XXH64 hashes of the word shingles (repeats included; fewer words: one of all; none: empty)."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD, -1), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.transform(
        F.array(hashed),  # binds the hashed words once
        lambda h: F.when(F.size(h) == 0, F.array().cast("array<long>"))
        .when(F.size(h) < shingle, F.array(F.aggregate(
            h, F.size(h).cast("long"), lambda a, x: F.xxhash64(a, x))))
        .otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - shingle),
                               lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(shingle)]))))[0]


def bin_digits(hashes: Column, seed: int = 11) -> Column:
    """The digit (0 to 15) of each bin after densification; empty for no hashes."""
    low_bits = (1 << _SHIFT) - 1
    # the largest hash of each signed bin marks the bin as empty if nothing lies below it
    bounds = [(b << _SHIFT) | low_bits for b in range(-BINS // 2, BINS // 2)]
    rng = np.random.default_rng(seed)
    start, step = rng.integers(0, BINS, BINS), rng.integers(0, BINS // 2, BINS) * 2 + 1
    # only a bin's least value follows the end of another bin
    least = F.transform(
        F.array(F.sort_array(F.concat(hashes, _longs(bounds)))),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, _SHIFT) != F.shiftright(F.get(s, i - 1), _SHIFT))))[0]
    value = F.transform(least, lambda x: F.when(x.bitwiseAND(F.lit(low_bits)) != low_bits,
                                                x.bitwiseAND(F.lit(low_bits))))

    inverse = [pow(int(x), -1, BINS) for x in step]

    def taken(o: Column, filled_bins: Column, i: Column) -> Column:
        """Value of the first bin in the order begin, begin + stride, ... that is not empty."""
        begin, stride, back = (F.get(o[k], i) for k in "bsk")
        # the first few tries directly; then the filled bin that comes first in that order
        tries = [F.get(o["v"], (begin + t * stride).bitwiseAND(F.lit(BINS - 1)).cast("int")) for t in range(TRIES)]
        first = F.array_min(F.transform(filled_bins, lambda j: ((j - begin) * back).bitwiseAND(F.lit(BINS - 1)) * BINS + j))
        return F.coalesce(*tries, F.get(o["v"], (first % BINS).cast("int")))

    def digit(o: Column, filled_bins: Column, x: Column, i: Column) -> Column:
        # a value that serves several bins gives each another of its digits
        shared = F.call_function("shiftright", taken(o, filled_bins, i), (i % (_SHIFT // DIGIT_BITS)) * DIGIT_BITS)
        return F.coalesce(x, shared).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")

    all_bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    orders = [_longs(values).alias(k) for k, values in (("b", start), ("s", step), ("k", inverse))]
    filled = F.transform(
        F.array(F.struct(value.alias("v"), *orders)),
        lambda o: F.transform(
            F.array(F.filter(all_bins, lambda j: F.get(o["v"], j).isNotNull())),
            lambda bins: F.transform(o["v"], lambda x, i: digit(o, bins, x, i)))[0])[0]
    return F.when(F.size(hashes) == 0, F.array().cast("array<int>")).otherwise(filled)


def as_hex(digits: Column) -> Column:
    """The packed digits as text (no words: all zeros)."""
    marks = F.lit("0123456789abcdef")
    return F.when(F.size(digits) == 0, F.lit("0" * BINS)).otherwise(
        F.array_join(F.transform(digits, lambda d: F.substring(marks, d + 1, F.lit(1))), ""))


def likeness(a: Column, b: Column) -> Column:
    """Bias-corrected estimate (0 to 1) of the Jaccard likeness of two fingerprints (hexadecimal text)."""
    none = "0" * BINS
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda e: e))
    chance = 1.0 / (1 << DIGIT_BITS)
    share = same / F.lit(float(BINS))
    return (F.when(a == b, F.lit(1.0)).when((a == none) | (b == none), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), (share - chance) / (1 - chance))))


def fingerprints(docs: DataFrame, text: str = "text", fingerprint: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` (all zeros for a text without words)."""
    hashes = free_name(docs, "_hashes")
    return (docs.withColumn(hashes, shingle_hashes(F.col(text)))
            .withColumn(fingerprint, as_hex(bin_digits(F.col(hashes)))).drop(hashes))


def with_next(docs: DataFrame, doc_id: str, columns: list[str], prefix: str = "next_") -> DataFrame:
    """Add ``columns`` of the next row by ascending doc_id (after the last: the first).

    Rows are dealt into ranges between doc_ids that occur. The first row of
    each range is also handed to the range before it, and that of the first
    range to the last, so each range finds its rows' successors by itself.
    Null doc_ids come first; equal ones are ordered by ``columns``.
    """
    spark = docs.sparkSession
    wanted = 4 * shuffle_width(spark)
    shares = [k / wanted for k in range(1, wanted)]
    row = docs.agg(F.percentile_approx(doc_id, shares).alias("q"), F.min(doc_id).alias("least"),
                   F.count_if(F.col(doc_id).isNull()).alias("nulls")).first()
    least = row["least"]
    edges = sorted({e for e in row["q"] or [] if e != least})
    i = F.col(doc_id)
    first = i.isNull() if row["nulls"] or least is None else i == F.lit(least)
    if edges:
        bounds, n = _longs(edges), len(edges)
        steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(n.bit_length()))])
        # number of edges at or below the id, by binary search (a null id is below all)
        place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
            (at + step <= n) & (F.get(bounds, at + step - 1) <= i), at + step).otherwise(at))
        docs = docs.withColumn("_range", place)
        starts = (F.col("_range") > 0) & F.array_contains(bounds, i)
    else:
        docs, starts = docs.withColumn("_range", F.lit(0)), F.lit(False)
    last = len(edges)
    handed = (F.when(first, F.lit(last)).when(F.coalesce(starts, F.lit(False)), F.col("_range") - 1))
    both = docs.withColumn("_to", F.explode(F.array_compact(F.array(
        F.struct(F.col("_range").alias("r"), F.lit(0).alias("wrap"), F.lit(False).alias("extra")),
        F.when(handed.isNotNull(), F.struct(handed.alias("r"), F.when(first, F.lit(1)).otherwise(F.lit(0)).alias("wrap"),
                                            F.lit(True).alias("extra")))))))
    both = both.select("*", *[F.col(f"_to.{k}").alias(f"_{k}") for k in ("r", "wrap", "extra")]).drop("_to", "_range")
    # all successors in one window over plain columns: one exchange carries the texts, once
    ordered = Window.partitionBy("_r").orderBy("_wrap", F.col(doc_id).asc_nulls_first(), "_extra", *columns)
    both = both.select("*", *[F.lead(c).over(ordered).alias(prefix + c) for c in columns])
    return both.where(~F.col("_extra")).drop("_r", "_wrap", "_extra")


def fingerprint_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text replaces a document's last floor(n/2) code points by the
    first as many (or all) of the next document. A null text is empty; a text
    without words has the fingerprint of zeros, is alike (1) to another such
    text and unlike (0) any other. Repeated rows follow one another; with one
    row the next document is itself; no rows give no rows; other columns are
    ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(fingerprints(rows), "doc_id", ["text", "fingerprint"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited).drop("text", "next_text")
    rows = fingerprints(rows, "edited", "edited_fingerprint")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
