"""Mixing sources to target weights with a time-varying curriculum.

Every source gets a target number of words: its weight's share of all words,
but at most ``cap`` times what the source holds; what lies above is shared
anew by weight until no source is above. Each source also has a schedule, a
weight that changes linearly over training time t in [0, 1] around its mean;
its integral is the source's cumulative demand, D(t) = target * ((1 - a) t + a t^2).

The source's documents form streams (large ones apart, see ``stream_targets``)
in the order of a hash, repeated up to ``cap`` times. A copy is taken if its middle lies before the target, and it
is trained at the time at which the cumulative demand reaches its first word,
D^-1(words before it). Sorting all copies by that time (a range partitioning,
no global task) gives the training order.

Only the table of sources passes through one task. A hot source is spread
over hash buckets, whose sums are added up apart (``running_totals``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import running_totals, staged

WEIGHTS = (5, 2, 1)
TILTS = (0.0, 0.5, -0.5)  # schedule of each weight class: level, growing, fading
CAP = 3
LARGE = 64


def _cycle(values: Sequence[float], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]),
                        (index % len(values) + 1).cast("int"))


def mixture_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
                    tilts: Sequence[float] = TILTS, cap: float = CAP) -> DataFrame:
    """(source, source_no, source_size, target, tilt) from rows of (source, size).

    Sources by code point, null last; weights and tilts repeat along them.
    The level at which weights are met is found in one pass: sources are taken
    in the order in which they reach their cap, and the level is that of the
    first source whose cap is not reached.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("source_no", F.row_number().over(order) - 1)
           .withColumn("weight", _cycle(weights, F.col("source_no")))
           .withColumn("tilt", _cycle(tilts, F.col("source_no")))
           .withColumn("most", F.col("source_size") * F.lit(float(cap))))
    fills = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    whole = Window.partitionBy()
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(
        fills.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("weight").over(fills.rowsBetween(0, Window.unboundedFollowing)))
    per = (per.withColumn("level", level)
           .withColumn("level", F.min(F.when(F.col("most") / F.col("weight") >= F.col("level"),
                                             F.struct(F.col("most") / F.col("weight"), "source_no", "level")))
                       .over(whole)["level"]))
    return per.select("source", "source_no", "source_size",
                      F.least("most", F.col("level") * F.col("weight")).alias("target"), "tilt")


def stream_key(doc_id: Column) -> Column:
    """Hash that orders a source's documents (null: as an empty text)."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def _position(words_before: Column, target: Column, tilt: Column) -> Column:
    """Training time at which the cumulative demand reaches ``words_before``."""
    u = words_before / target
    even = F.lit(1.0) - tilt
    return F.when(target > 0, F.least(F.lit(1.0), F.round(
        F.lit(2.0) * u / (even + F.sqrt(even * even + F.lit(4.0) * tilt * u)), 9)))


def _copies(before: Column, size: Column, total: Column, target: Column, cap: int) -> list[Column]:
    """For each repetition of the stream: is the row's copy taken (its middle lies before the target)."""
    return [F.lit(2) * (F.lit(p) * total + before) + size < F.lit(2) * target for p in range(cap)]


def _keyed(docs: DataFrame, size: Column, source: str, doc_id: str) -> list[Column]:
    return [F.col(source).alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"), stream_key(F.col(doc_id)).alias("key"),
            F.col(doc_id).alias("id")]


def _with_totals(rows: DataFrame, sources: DataFrame, n: int, *ties: Column) -> DataFrame:
    """Rows with their source's figures and the words before them in their stream."""
    # buckets only divide the work: of about 100 rows, at most 65,536 of them
    buckets = max(1, min(65_536, n // 100))
    rows = (rows.join(sources.withColumnRenamed("source", "_source"),
                      F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("large", F.col("size") * LARGE > F.col("source_size"))
            .withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
                                          * buckets / F.lit(float(1 << 32))).cast("int")))
    return running_totals(rows, ["source_no", "large"], "bucket", ["key", "id", "size", *ties], "size", "before")


def stream_targets(thin: DataFrame, n: int, weights: Sequence[float] = WEIGHTS, tilts: Sequence[float] = TILTS,
                   cap: int = CAP) -> DataFrame:
    """Figures of each source from staged rows (source, size, key, id).

    A source is two streams: its large documents (over 1/``LARGE`` of its
    words, so fewer than ``LARGE``) and the others. The large ones are cut
    first; what they miss or exceed goes to the target of the small ones, so
    the source ends within half a small document of its target.
    """
    sources = staged(mixture_targets(thin.select("source", "size"), weights, tilts, cap), "mix-targets")
    large = thin.join(sources.select(F.col("source").alias("_s"), "source_size"),
                      F.col("source").eqNullSafe(F.col("_s"))).where(F.col("size") * LARGE > F.col("source_size"))
    sums = large.groupBy("source").agg(F.sum("size").alias("large_size"))
    held = (sources.join(sums.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
            .drop("_s").withColumn("large_size", F.coalesce("large_size", F.lit(0)))
            .withColumn("large_target", F.when(F.col("source_size") > 0, F.col("target") * F.col("large_size")
                                               / F.col("source_size")).otherwise(F.lit(0.0))))
    cut = _with_totals(large.drop("_s", "source_size"), held, n)
    taken = sum((t.cast("int") for t in _copies(F.col("before"), F.col("size"), F.col("large_size"),
                                                F.col("large_target"), cap)), F.lit(0))
    done = cut.groupBy("source").agg(F.sum(F.col("size") * taken).alias("large_taken"))
    return staged(held.join(done.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
                  .drop("_s").withColumn("small_target", F.greatest(F.lit(0.0), F.least(
                      F.col("target") - F.coalesce("large_taken", F.lit(0)),
                      F.lit(float(cap)) * (F.col("source_size") - F.col("large_size")))))
                  .drop("large_taken"), "mix-sources")


def curriculum(docs: DataFrame, size: Column, source: str = "source", doc_id: str = "doc_id",
               weights: Sequence[float] = WEIGHTS, tilts: Sequence[float] = TILTS, cap: int = CAP) -> DataFrame:
    """One row per row of ``docs``: (doc struct, key, size, source_size, target, copies, taken, positions).

    ``size`` is a long column over ``docs``; ``positions`` holds the training
    time of each copy. The input's columns travel inside the struct ``doc``,
    so clashing names do not matter. Null sources are one source, ordered
    last; rows of size 0 take 0 words; repeated rows are separate documents;
    equal hashes are ordered by doc_id, then size, then the whole row; no rows
    give no rows.
    """
    thin = staged(docs.select(*_keyed(docs, size, source, doc_id)), "mix-thin")
    n = thin.count()
    sources = stream_targets(thin, n, weights, tilts, cap)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), *_keyed(docs, size, source, doc_id))
    rows = _with_totals(rows, sources, n, F.xxhash64("doc"))
    total = F.when(F.col("large"), F.col("large_size")).otherwise(F.col("source_size") - F.col("large_size"))
    target = F.when(F.col("large"), F.col("large_target")).otherwise(F.col("small_target"))
    taken = _copies(F.col("before"), F.col("size"), total, target, cap)
    copies = sum((t.cast("int") for t in taken[1:]), taken[0].cast("int"))
    return (rows.withColumn("copies", copies)
            .withColumn("taken", (F.col("size") * F.col("copies")).cast("long"))
            .withColumn("positions", F.array_compact(F.array(*[
                F.when(t, _position(F.lit(p) * total + F.col("before"), target, F.col("tilt")))
                for p, t in enumerate(taken)])))
            .select("doc", "key", "size", "source_size", "target", "copies", "taken", "positions"))


def training_order(mixed: DataFrame) -> DataFrame:
    """The taken copies, range-sorted by training position: the columns of ``doc`` only."""
    copies = mixed.select("doc", "key", F.posexplode("positions").alias("copy", "position"))
    parts = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (copies.repartitionByRange(parts, "position", "key", "copy")
            .sortWithinPartitions("position", "key", "copy").select("doc.*"))
