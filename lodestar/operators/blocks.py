"""Frame rasters as blocks: one row per frame with its values packed behind a validity bitmap.

A block has ``valid`` and ``hot`` (a bit per cell in raster order, 64 cells a
word), ``starts`` (valid cells before each word) and ``v`` (the values of the
valid cells). Blocks are put together and taken apart by built-in functions:
the cells of a word meet in a first aggregate, the words of a frame in a
second, and gaps between words are filled by repeating zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.grid import FRAME_KEYS, GridSpec

WORD = 64


def n_words(spec: GridSpec) -> int:
    return -(-spec.width * spec.height // WORD)


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def _filled(words: Column, field: str, total: int, gap: Column | None = None) -> Column:
    """``field`` of the sorted words at their place in an array of ``total``; gaps hold 0, or the next start."""
    before = F.slice(F.concat(F.array(F.lit(-1)), F.transform(words, lambda w: w["word"])), 1, F.size(words))
    runs = F.zip_with(words, before, lambda w, last: F.concat(
        F.array_repeat(w[field] if gap is not None else F.lit(0).cast("bigint"), w["word"] - last - 1), F.array(w[field])))
    rest = F.lit(total) - F.coalesce(F.try_element_at(words, F.lit(-1))["word"], F.lit(-1)) - 1
    return F.concat(F.flatten(runs), F.array_repeat(gap if gap is not None else F.lit(0).cast("bigint"), rest))


def pack_blocks(binary: DataFrame, frames: DataFrame, spec: GridSpec = GridSpec()) -> DataFrame:
    """One row for every frame: ``frame_row, frame_col, n_valid, valid, hot, starts, v``.

    ``binary`` has one row per covered cell with ``v`` and ``bit``; cells with
    a NULL value count as blank. Frames without cells have empty bitmaps. A
    cell outside its frame, or of a frame that is not in ``frames``, fails the
    query.
    """
    cell = F.col("cell_row") * spec.width + F.col("cell_col")
    inside = F.col("cell_row").between(0, spec.height - 1) & F.col("cell_col").between(0, spec.width - 1)
    cell = F.when(inside, cell).otherwise(F.raise_error(F.concat(
        F.lit("cell outside its frame: "), F.concat_ws(" ", "frame_row", "frame_col", "cell_row", "cell_col"))).cast("int"))
    cells = binary.filter(F.col("v").isNotNull()).select(
        *FRAME_KEYS, cell.alias("_cell"), F.col("v").cast("double").alias("v"), F.coalesce("bit", F.lit(0)).alias("bit"))
    at = F.col("_cell").bitwiseAND(F.lit(WORD - 1))
    words = cells.groupBy(*FRAME_KEYS, F.shiftright("_cell", 6).alias("word")).agg(
        F.bit_or(_bit(at)).alias("valid"), F.bit_or(F.when(F.col("bit") == 1, _bit(at)).otherwise(F.lit(0).cast("bigint"))).alias("hot"),
        F.transform(F.array_sort(F.collect_list(F.struct("_cell", "v"))), lambda c: c["v"]).alias("vs"))
    before = Window.partitionBy(*FRAME_KEYS).orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    words = words.withColumn("start", F.coalesce(F.sum(F.bit_count("valid")).over(before), F.lit(0)).cast("int"))
    packed = words.groupBy(*FRAME_KEYS).agg(
        F.array_sort(F.collect_list(F.struct("word", "valid", "hot", "start", "vs"))).alias("words"))
    # a full join, so that a cell of an unknown frame is noticed
    known = frames.select(*FRAME_KEYS, F.lit(True).alias("_known"))
    both = known.join(packed, list(FRAME_KEYS), "full")
    name = F.concat(F.lit("a cell lies in a frame that is not in the grid: r"), F.col("frame_row").cast("string"),
                    F.lit("_c"), F.col("frame_col").cast("string"))
    both = both.withColumn("words", F.when(F.col("_known").isNull(), F.raise_error(name).cast(packed.schema["words"].dataType))
                           .otherwise(F.coalesce("words", F.array().cast(packed.schema["words"].dataType))))
    total, words = n_words(spec), F.col("words")
    both = both.withColumn("v", F.flatten(F.transform(words, lambda w: w["vs"])))
    return both.select(
        *FRAME_KEYS, F.size("v").alias("n_valid"), _filled(words, "valid", total).alias("valid"),
        _filled(words, "hot", total).alias("hot"), _filled(words, "start", total, F.size("v")).alias("starts"), "v")


def unpack_blocks(blocks: DataFrame, spec: GridSpec = GridSpec(), dense: bool = True) -> DataFrame:
    """The cells of blocks: ``frame_row, frame_col, cell_row, cell_col, v, bit``.

    ``dense`` gives every cell, NULL where nothing is; otherwise the valid ones only.
    """
    def word_at(w: Column) -> Column:
        here = {c: F.get(c, w) for c in ("valid", "hot", "starts")}
        held = F.slice("v", here["starts"] + 1, F.bit_count(here["valid"]))
        return F.struct(w.alias("word"), here["valid"].alias("valid"), here["hot"].alias("hot"), held.alias("vs"))

    # a generated stage keeps all that it makes of one input row until that row is done. A lambda is not part of
    # such a stage: words pass it one by one, and the next stage keeps one word's cells, not a frame's
    words = blocks.select(*FRAME_KEYS, F.inline(F.transform(F.sequence(F.lit(0), F.lit(n_words(spec) - 1)), word_at)))
    cells = words.select("*", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1))).alias("k"))
    k = F.col("k")
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), k))
    set_ = F.call_function("getbit", F.col("valid"), k) == 1
    at = F.col("word") * WORD + k
    v = F.when(set_, F.try_element_at("vs", F.bit_count(F.col("valid").bitwiseAND(below)) + 1))
    cells = cells.select(*FRAME_KEYS, "hot", "k", at.alias("at"), v.alias("v"))
    cells = cells.filter((F.col("at") < spec.width * spec.height) if dense else F.col("v").isNotNull())
    return cells.select(*FRAME_KEYS, F.expr(f"at div {spec.width}").cast("int").alias("cell_row"),
                        (F.col("at") % spec.width).alias("cell_col"), "v",
                        F.when(F.col("v").isNotNull(), F.call_function("getbit", F.col("hot"), F.col("k")).cast("int")).alias("bit"))
