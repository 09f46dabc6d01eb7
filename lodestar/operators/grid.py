"""Map-frame grid: frames over an extent, blank frame cells, the frame index,
scene-to-frame overlap and pixel-to-cell placement.

The grid is anchored at the extent's top-left corner (minx, maxy); frame
rows count downwards, frame columns to the right. Every frame holds
``width x height`` cells of ``res`` map units.

Nothing here builds lists on the driver: frames come from
``explode(sequence(...))`` over blocks of the one-row extent, and pixels are placed by
arithmetic against that row, read as a scalar subquery -- no join at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import shuffle_width

FRAME_KEYS = ("frame_row", "frame_col")
BLOCK_LEVEL = 5  # frames are listed, and meet scenes, in blocks of 2^BLOCK_LEVEL frames a side
FOOTPRINT_BLOCK = 32  # side in cells of the neighbourhoods in which footprints are listed


@dataclass(frozen=True)
class GridSpec:
    """Frame size: ``width x height`` cells of ``res`` units each."""

    # 250 x 200 cells of 500 map units per frame.
    res: float = 500.0
    width: int = 250
    height: int = 200

    @property
    def frame_w(self) -> float:
        return float(self.res) * self.width

    @property
    def frame_h(self) -> float:
        return float(self.res) * self.height


def _steps(span: Column, step: float) -> Column:
    """Number of steps covering ``span``; at least one (a zero-area extent gets one)."""
    return F.greatest(F.lit(1), F.ceil(span / F.lit(float(step))).cast("int"))


def _range(lo: Column, hi: Column) -> Column:
    """``[lo, hi]`` as an int array; empty (never descending) when ``lo > hi``."""
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def grid_shape(extent: DataFrame, spec: GridSpec = GridSpec()) -> DataFrame:
    """The one-row extent plus its cell and frame counts."""
    span_x = F.col("maxx") - F.col("minx")
    span_y = F.col("maxy") - F.col("miny")
    return extent.select(
        "minx", "maxx", "miny", "maxy",
        _steps(span_x, spec.res).alias("n_cells_x"),
        _steps(span_y, spec.res).alias("n_cells_y"),
        _steps(span_x, spec.frame_w).alias("n_frame_cols"),
        _steps(span_y, spec.frame_h).alias("n_frame_rows"),
    )


def grid_scalar(extent: DataFrame, spec: GridSpec = GridSpec()) -> Column:
    """The one-row extent and its grid counts as a scalar-subquery struct column.

    Spark runs the subquery once and reuses it wherever a field is read, so
    pixels need no join with the extent. ``scalar()`` also enforces the size
    bound: an extent with more than one row fails the query.
    """
    shape = grid_shape(extent, spec)
    return shape.select(F.struct(*shape.columns).alias("grid")).scalar()


def frame_name(row: Column | str = "frame_row", col: Column | str = "frame_col") -> Column:
    """Frame label ``r{row}_c{col}``."""
    row = F.col(row) if isinstance(row, str) else row
    col = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit("r"), row.cast("string"), F.lit("_c"), col.cast("string"))


def grid_blocks(extent: DataFrame, spec: GridSpec = GridSpec()) -> DataFrame:
    """One row per block of 2^BLOCK_LEVEL frames a side: ``block_row, block_col``, the grid's corner and frame counts.

    Dealt by block to every core.
    """
    shape = grid_shape(extent, spec).select("minx", "maxy", "n_frame_cols", "n_frame_rows")
    n = {c: (F.shiftright(F.col(f"n_frame_{c}") - 1, BLOCK_LEVEL) + 1).cast("bigint") for c in ("rows", "cols")}
    blocks = shape.withColumn("_wide", n["cols"]).withColumn("_at", F.explode(F.sequence(F.lit(0).cast("bigint"), n["rows"] * F.col("_wide") - 1)))
    blocks = blocks.withColumns({"block_row": F.expr("_at div _wide").cast("int"), "block_col": (F.col("_at") % F.col("_wide")).cast("int")})
    return blocks.drop("_at", "_wide").repartition(shuffle_width(extent.sparkSession), "block_row", "block_col")


def _frame_columns(spec: GridSpec, prefix: str = "") -> list[Column]:
    """Keys, name and bounds (``prefix`` before these) of the frame at ``frame_row, frame_col`` of the grid at ``minx, maxy``."""
    fw, fh = F.lit(spec.frame_w), F.lit(spec.frame_h)
    return [
        F.col("frame_row"), F.col("frame_col"),
        frame_name().alias("name"),
        (F.col("minx") + F.col("frame_col") * fw).alias(prefix + "minx"),
        (F.col("minx") + (F.col("frame_col") + 1) * fw).alias(prefix + "maxx"),
        (F.col("maxy") - (F.col("frame_row") + 1) * fh).alias(prefix + "miny"),
        (F.col("maxy") - F.col("frame_row") * fh).alias(prefix + "maxy"),
    ]


def frame_grid(extent: DataFrame, spec: GridSpec = GridSpec()) -> DataFrame:
    """One row per frame: ``frame_row, frame_col, name, minx, maxx, miny, maxy``.

    The frame count is ``ceil(w / frame_w) * ceil(h / frame_h)`` -- it grows
    with the covered area, never with the number of pixels.
    """
    # the one-row extent lists blocks of frames; spread, they list their frames on every core
    blocks = grid_blocks(extent, spec)
    side = F.lit(1 << BLOCK_LEVEL)
    frames = blocks.withColumns({"_high": F.least(side, F.col("n_frame_rows") - F.col("block_row") * side),
                                 "_wide": F.least(side, F.col("n_frame_cols") - F.col("block_col") * side)})
    frames = frames.withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_high") * F.col("_wide") - 1)))
    frames = frames.select("minx", "maxy", (F.col("block_row") * side + F.expr("_at div _wide").cast("int")).alias("frame_row"),
                           (F.col("block_col") * side + F.col("_at") % F.col("_wide")).alias("frame_col"))
    frames = frames.select(*_frame_columns(spec))
    # an operator that joins these very frames may join their blocks first (see scene_frame_join); what is
    # derived from the frames, such as some of them, is a new DataFrame without this mark
    frames._grid = (extent, spec, blocks)
    return frames


def empty_frames(frames: DataFrame, spec: GridSpec = GridSpec()) -> DataFrame:
    """Every cell of every frame with its centre and a NULL value (a blank raster).

    Generated in the executors by two explodes per frame, after spreading
    the (small) frame list over the cluster; only build this when a dense
    output is really wanted.
    """
    res = F.lit(float(spec.res))
    # frames come out of one task (they are exploded from the one-row
    # extent); spread them so the cells are generated on every core
    spread = frames.repartition(shuffle_width(frames.sparkSession), *FRAME_KEYS)
    # a generated stage keeps all that it makes of one input row until that row is done. A lambda is not part of
    # such a stage: rows of cells pass it one by one, and the next stage keeps one row's cells, not a frame's
    rows = spread.select("frame_row", "frame_col", "minx", F.inline(F.transform(
        F.sequence(F.lit(0), F.lit(spec.height - 1)),
        lambda r: F.struct(r.alias("cell_row"), (F.col("maxy") - (r + F.lit(0.5)) * res).alias("y")))))
    cells = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(spec.width - 1))).alias("cell_col"))
    return cells.select(
        "frame_row", "frame_col", "cell_row", "cell_col",
        (F.col("minx") + (F.col("cell_col") + F.lit(0.5)) * res).alias("x"), "y",
        F.lit(None).cast("double").alias("v"),
    )


def frame_index(frames: DataFrame, directory: str = "", suffix: str = ".TIF") -> DataFrame:
    """The frame index: name, output path and footprint of every frame."""
    return frames.select(
        "name",
        F.concat(F.lit(directory), F.col("name"), F.lit(suffix)).alias("path"),
        "frame_row", "frame_col", "minx", "maxx", "miny", "maxy",
    )


# Boxes of frames are covered by square cells of 2^level frames a side, at most 2^MAX_LEVEL.
MAX_LEVEL = 20
# A cell of blocks lists at most 4^COVER_LEVEL of them.
COVER_LEVEL = 5


def box_cover(boxes: DataFrame, c_lo: Column, c_hi: Column, r_lo: Column, r_hi: Column,
              max_level: int = MAX_LEVEL) -> DataFrame:
    """Cover each box of frames (inclusive ranges) by cells ``level, cell_row, cell_col`` that don't overlap.

    A cell of level L has 2^L frames a side. A box takes the cells of a level
    that lie wholly inside it and in no larger one: a ring at most one cell
    wide on each side. So its rows grow with its border, not with its area.
    """
    def inside(lo: Column, hi: Column, level: Column) -> tuple[Column, Column]:
        size = F.call_function("shiftleft", F.lit(1), level)
        first = F.call_function("shiftright", lo + size - 1, level)
        return first, F.call_function("shiftright", hi + 1, level) - 1

    spans = boxes.withColumns({"_cl": c_lo, "_ch": c_hi, "_rl": r_lo, "_rh": r_hi}).filter(
        (F.col("_cl") <= F.col("_ch")) & (F.col("_rl") <= F.col("_rh")))
    longest = F.greatest(F.least(F.col("_ch") - F.col("_cl"), F.col("_rh") - F.col("_rl")) + 1, F.lit(1))
    top = F.least(F.lit(max_level), F.floor(F.log2(longest.cast("double"))).cast("int"))
    spans = spans.withColumn("_top", top).withColumn("level", F.explode(F.sequence(F.lit(0), F.col("_top"))))
    level = F.col("level")
    here = [*inside(F.col("_cl"), F.col("_ch"), level), *inside(F.col("_rl"), F.col("_rh"), level)]
    spans = spans.withColumns(dict(zip(("_c0", "_c1", "_r0", "_r1"), here))).filter("_c0 <= _c1 and _r0 <= _r1")
    # the children of the next level's cells are taken already
    above = [*inside(F.col("_cl"), F.col("_ch"), level + 1), *inside(F.col("_rl"), F.col("_rh"), level + 1)]
    spans = spans.withColumns(dict(zip(("_d0", "_d1", "_e0", "_e1"), above)))
    taken = (F.col("_d0") <= F.col("_d1")) & (F.col("_e0") <= F.col("_e1")) & (level < F.col("_top"))
    c0, c1, r0, r1 = (F.col(c) for c in ("_c0", "_c1", "_r0", "_r1"))
    d0, d1, e0, e1 = F.col("_d0") * 2, F.col("_d1") * 2 + 1, F.col("_e0") * 2, F.col("_e1") * 2 + 1

    def strip(a: Column, b: Column, c: Column, d: Column) -> Column:
        return F.struct(a.alias("c0"), b.alias("c1"), c.alias("r0"), d.alias("r1"))

    ring = F.array(strip(c0, c1, r0, e0 - 1), strip(c0, c1, e1 + 1, r1), strip(c0, d0 - 1, e0, e1), strip(d1 + 1, c1, e0, e1))
    spans = spans.withColumn("_s", F.explode(F.when(taken, ring).otherwise(F.array(strip(c0, c1, r0, r1)))))
    spans = spans.withColumn("cell_col", F.explode(_range(F.col("_s.c0"), F.col("_s.c1"))))
    spans = spans.withColumn("cell_row", F.explode(_range(F.col("_s.r0"), F.col("_s.r1"))))
    return spans.select(*boxes.columns, "level", "cell_row", "cell_col")


def scene_frame_join(scene_extents: DataFrame, extent: DataFrame, frames: DataFrame,
                     spec: GridSpec = GridSpec(), scene: str = "scene") -> DataFrame:
    """Which frames each scene's box overlaps (open boxes: touching edges do not count).

    Instead of a theta join (a nested loop over scenes x frames), the range
    of frames that a scene's box can reach -- widened by one frame against
    rounding -- is put in blocks of 2^BLOCK_LEVEL frames a side. These are covered
    by cells of several levels (:func:`box_cover`), which are spread and list their
    blocks. An equi-join on the block finds the pairs and the exact box test then
    filters. A scene over millions of frames sends one row per block, from every
    core. Spark cannot see how many frames an extent makes, so the join is never a broadcast.

    Where ``frames`` is the :func:`frame_grid` of this extent, its blocks are joined
    before they list their frames, so that blocks are dealt and sorted, not
    frames, and a pair lists only frames in the scene's range. Other frames
    (some of a grid's) are dealt by their block.
    """
    fw, fh = F.lit(spec.frame_w), F.lit(spec.frame_h)
    g = grid_scalar(extent, spec)
    s = scene_extents.select(scene, *[F.col(c).alias("s_" + c) for c in ("minx", "maxx", "miny", "maxy")])
    s = s.withColumns({"_gx0": g.getField("minx"), "_gy0": g.getField("maxy"),
                       "n_frame_cols": g.getField("n_frame_cols"), "n_frame_rows": g.getField("n_frame_rows")})
    c_lo = F.greatest(F.lit(0), F.floor((F.col("s_minx") - F.col("_gx0")) / fw).cast("int") - 1)
    c_hi = F.least(F.col("n_frame_cols") - 1, F.ceil((F.col("s_maxx") - F.col("_gx0")) / fw).cast("int"))
    r_lo = F.greatest(F.lit(0), F.floor((F.col("_gy0") - F.col("s_maxy")) / fh).cast("int") - 1)
    r_hi = F.least(F.col("n_frame_rows") - 1, F.ceil((F.col("_gy0") - F.col("s_miny")) / fh).cast("int"))
    s = s.withColumns({"c_lo": c_lo, "c_hi": c_hi, "r_lo": r_lo, "r_hi": r_hi}).filter("c_lo <= c_hi and r_lo <= r_hi")

    def block(c: str) -> Column:
        return F.shiftright(c, BLOCK_LEVEL)

    cells = box_cover(s, block("c_lo"), block("c_hi"), block("r_lo"), block("r_hi"), COVER_LEVEL)
    cells = cells.repartition(shuffle_width(scene_extents.sparkSession), "level", "cell_row", "cell_col")
    for c in ("cell_row", "cell_col"):
        start = F.call_function("shiftleft", F.col(c), F.col("level"))
        side = F.call_function("shiftleft", F.lit(1), F.col("level"))
        cells = cells.withColumn(c.replace("cell", "block"), F.explode(F.sequence(start, start + side - 1)))
    box = ("s_minx", "s_maxx", "s_miny", "s_maxy")
    cells = cells.select(scene, *box, "c_lo", "c_hi", "r_lo", "r_hi", "block_row", "block_col").hint("merge")
    on = ["block_row", "block_col"]
    of_extent, of_spec, blocks = frames.__dict__.get("_grid", (None, None, None))
    if of_extent is extent and of_spec == spec:
        met = cells.join(blocks, on)
        for c, lo, hi in (("row", "r_lo", "r_hi"), ("col", "c_lo", "c_hi")):
            start = F.col(f"block_{c}") * (1 << BLOCK_LEVEL)
            last = start + ((1 << BLOCK_LEVEL) - 1)
            met = met.withColumn(f"frame_{c}", F.explode(_range(F.greatest(F.col(lo), start), F.least(F.col(hi), last))))
        met = met.select(scene, *box, *_frame_columns(spec, "f_"))
    else:
        f = frames.select("frame_row", "frame_col", "name", *[F.col(c).alias("f_" + c) for c in ("minx", "maxx", "miny", "maxy")])
        met = cells.join(f.withColumns({c: block(c.replace("block", "frame")) for c in on}), on)
    hit = ((F.col("s_minx") < F.col("f_maxx")) & (F.col("s_maxx") > F.col("f_minx"))
           & (F.col("s_miny") < F.col("f_maxy")) & (F.col("s_maxy") > F.col("f_miny")))
    return met.filter(hit).select(scene, "frame_row", "frame_col", "name")


def _inside(g: Column, px: Column, py: Column) -> Column:
    """The pixel has coordinates and they lie in the extent (never NULL)."""
    has = px.isNotNull() & py.isNotNull() & ~F.isnan(px.cast("double")) & ~F.isnan(py.cast("double"))
    return F.coalesce(has & (px >= g.getField("minx")) & (px <= g.getField("maxx"))
                      & (py >= g.getField("miny")) & (py <= g.getField("maxy")), F.lit(False))


def _checked(pixels: DataFrame, g: Column, px: Column, py: Column, outside: str) -> DataFrame:
    """The pixels whose coordinates lie in the extent; others fail the query or are clipped."""
    if outside not in ("fail", "clip"):
        raise ValueError(f"unknown handling of outside pixels {outside!r}; use fail or clip")
    inside = _inside(g, px, py)
    if outside == "fail":
        inside = F.when(inside, F.lit(True)).otherwise(F.raise_error(F.concat(
            F.lit("pixel outside the extent: "), F.coalesce(px.cast("string"), F.lit("NULL")), F.lit(" "),
            F.coalesce(py.cast("string"), F.lit("NULL")))).cast("boolean"))
    return pixels.filter(inside)


def unplaced_pixels(pixels: DataFrame, extent: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """The pixels that no cell of the extent takes, with ``reason``: ``no coordinates`` or ``outside``."""
    g = grid_scalar(extent)
    px, py = F.col(x), F.col(y)
    none = px.isNull() | py.isNull() | F.isnan(px.cast("double")) | F.isnan(py.cast("double"))
    return (pixels.filter(~_inside(g, px, py))
            .withColumn("reason", F.when(none, F.lit("no coordinates")).otherwise(F.lit("outside"))))


def pixel_to_frame(pixels: DataFrame, extent: DataFrame, spec: GridSpec = GridSpec(),
                   x: str = "x", y: str = "y", outside: str = "fail") -> DataFrame:
    """Place each pixel in the grid: ``gx, gy`` (global cell), frame and cell in frame.

    Pure arithmetic against the extent, read once as a scalar subquery --
    no join with the extent or with the frame table. A pixel exactly on the
    max-x or min-y edge goes to the last cell. ``outside`` says what happens
    to pixels outside the extent or without coordinates: ``fail`` the query,
    or ``clip`` them (:func:`unplaced_pixels` returns those).
    """
    res = F.lit(float(spec.res))
    g = grid_scalar(extent, spec)
    px, py = F.col(x), F.col(y)
    gx = F.least(F.floor((px - g.getField("minx")) / res).cast("int"), g.getField("n_cells_x") - 1)
    gy = F.least(F.floor((g.getField("maxy") - py) / res).cast("int"), g.getField("n_cells_y") - 1)
    return _checked(pixels, g, px, py, outside).withColumns({"gx": gx, "gy": gy}).withColumns(cell_of(spec))


def pixel_footprint(pixels: DataFrame, extent: DataFrame, spec: GridSpec = GridSpec(), pixel_size: float | Column | str = 500.0,
                    x: str = "x", y: str = "y", outside: str = "fail") -> DataFrame:
    """Every cell that a pixel's square covers, with ``weight``: the share of the cell that it covers.

    ``x, y`` are the square's centre and ``pixel_size`` its side (a number or
    a column), so pixels larger than a cell leave no hole and smaller ones
    count by their area. Parts beyond the extent are cut off; ``outside`` is for
    centres outside it, as in :func:`pixel_to_frame`. A side that is not
    positive covers nothing. Adds ``gx, gy``, frame, cell in frame, ``weight`` and
    the cell's neighbourhood ``near_x, near_y``, by which the rows are dealt.
    """
    res = F.lit(float(spec.res))
    g = grid_scalar(extent, spec)
    size = F.col(pixel_size) if isinstance(pixel_size, str) else pixel_size if isinstance(pixel_size, Column) else F.lit(float(pixel_size))
    half = size / F.lit(2.0)
    placed = _checked(pixels, g, F.col(x), F.col(y), outside)
    # edges in cells from the grid's corner, cut at the extent
    wide, high = ((g.getField(a) - g.getField(b)) / res for a, b in (("maxx", "minx"), ("maxy", "miny")))
    left, right = (F.col(x) - half - g.getField("minx")) / res, (F.col(x) + half - g.getField("minx")) / res
    above, below = (g.getField("maxy") - F.col(y) - half) / res, (g.getField("maxy") - F.col(y) + half) / res
    placed = placed.withColumns({"_l": F.greatest(F.lit(0.0), left), "_r": F.least(wide, right),
                                 "_a": F.greatest(F.lit(0.0), above), "_b": F.least(high, below)})
    placed = placed.filter((F.col("_l") < F.col("_r")) & (F.col("_a") < F.col("_b")))
    # a pixel goes to each neighbourhood it touches and becomes cells there: an aggregate by neighbourhood
    # and cell needs no further exchange, so pixels are dealt, not the many cells that they cover
    columns = F.floor("_l").cast("int"), (F.ceil("_r") - 1).cast("int")
    rows = F.floor("_a").cast("int"), (F.ceil("_b") - 1).cast("int")
    for at, (lo, hi) in (("near_x", columns), ("near_y", rows)):
        placed = placed.withColumn(at, F.explode(F.sequence(*[F.floor(c / F.lit(FOOTPRINT_BLOCK)).cast("int") for c in (lo, hi)])))
    placed = placed.repartition(shuffle_width(pixels.sparkSession), "near_x", "near_y")
    for at, near, (lo, hi) in (("gx", "near_x", columns), ("gy", "near_y", rows)):
        start = F.col(near) * FOOTPRINT_BLOCK
        placed = placed.withColumn(at, F.explode(F.sequence(F.greatest(lo, start), F.least(hi, start + FOOTPRINT_BLOCK - 1))))
    share = ((F.least(F.col("_r"), F.col("gx") + F.lit(1.0)) - F.greatest(F.col("_l"), F.col("gx").cast("double")))
             * (F.least(F.col("_b"), F.col("gy") + F.lit(1.0)) - F.greatest(F.col("_a"), F.col("gy").cast("double"))))
    # what rounding leaves beyond a cell's edge is no cover
    placed = placed.withColumn("weight", share).filter(F.col("weight") > 1e-9)
    return placed.drop("_l", "_r", "_a", "_b").withColumns(cell_of(spec))


def cell_of(spec: GridSpec = GridSpec(), gx: str = "gx", gy: str = "gy") -> dict[str, Column]:
    """Frame and in-frame cell columns of a global cell ``(gx, gy)``."""
    frame_col = F.floor(F.col(gx) / F.lit(spec.width)).cast("int")
    frame_row = F.floor(F.col(gy) / F.lit(spec.height)).cast("int")
    return {
        "frame_row": frame_row,
        "frame_col": frame_col,
        "cell_row": F.col(gy) - frame_row * F.lit(spec.height),
        "cell_col": F.col(gx) - frame_col * F.lit(spec.width),
    }
