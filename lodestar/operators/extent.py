"""Bounding boxes: per-scene extents, parsing, union and text forms.

An extent is four DOUBLE columns ``minx, maxx, miny, maxy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.decode import FLOAT_PATTERN, FLOAT_SUFFIX
from lodestar.functions.strings import ColumnOrName, _col, java_trim
from lodestar.schema import EXTENT_SEPARATOR

EXTENT_COLS = ("minx", "maxx", "miny", "maxy")

# The two orders extent text comes in.
ORDERS = {
    "plain": ("minx", "maxx", "miny", "maxy"),
    "shell": ("minx", "maxx", "maxy", "miny"),
}


def _valid_xy(x: Column, y: Column) -> Column:
    return x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)


def scene_extent(pixels: DataFrame, scene: str = "scene", x: str = "x", y: str = "y",
                 pixel_size: float = 500.0) -> DataFrame:
    """Bounding box of each scene's pixel footprints (centres +- half a pixel).

    A partial/final hash aggregate: map tasks emit one row per scene they
    saw, so even a scene holding most of the rows does not skew the shuffle.
    """
    h = float(pixel_size) / 2.0
    return (pixels.select(scene, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
            .filter(_valid_xy(F.col("_x"), F.col("_y")))
            .groupBy(scene)
            .agg((F.min("_x") - F.lit(h)).alias("minx"), (F.max("_x") + F.lit(h)).alias("maxx"),
                 (F.min("_y") - F.lit(h)).alias("miny"), (F.max("_y") + F.lit(h)).alias("maxy")))


def parse_double(c: ColumnOrName) -> Column:
    """Text to DOUBLE with the strict grammar of the catalog decoder; bad text is NULL."""
    s = java_trim(_col(c))
    return F.when(s.rlike(FLOAT_PATTERN), F.regexp_replace(s, FLOAT_SUFFIX, "").try_cast("double"))


def parse_extent(text: ColumnOrName, order: str = "plain", prefix: str = "") -> list[Column]:
    """Four extent columns from ``"a b c d"`` text in ``order`` (``plain`` or ``shell``).

    Whatever the order claims, the result is normalised so that
    ``minx <= maxx`` and ``miny <= maxy``. A text that is not four numbers
    gives four NULLs (:func:`extent_error` says why).
    """
    names = ORDERS[order]
    parts = F.split(_col(text), EXTENT_SEPARATOR, -1)
    good = extent_error(text).isNull()
    raw = {name: parse_double(F.try_element_at(parts, F.lit(i + 1))) for i, name in enumerate(names)}
    x1, x2, y1, y2 = raw["minx"], raw["maxx"], raw["miny"], raw["maxy"]
    return [F.when(good, F.least(x1, x2)).alias(prefix + "minx"),
            F.when(good, F.greatest(x1, x2)).alias(prefix + "maxx"),
            F.when(good, F.least(y1, y2)).alias(prefix + "miny"),
            F.when(good, F.greatest(y1, y2)).alias(prefix + "maxy")]


def extent_error(text: ColumnOrName) -> Column:
    """Why a text is no extent: ``missing``, ``arity`` (not four parts) or ``number``; NULL if it is one."""
    t = _col(text)
    parts = F.split(t, EXTENT_SEPARATOR, -1)
    return (F.when(t.isNull(), F.lit("missing"))
            .when(F.size(parts) != 4, F.lit("arity"))
            .when(F.exists(parts, lambda p: parse_double(p).isNull()), F.lit("number")))


def extent_union(extents: DataFrame) -> DataFrame:
    """One-row union of all extents: min of mins, max of maxes.

    Rows with a NaN or NULL coordinate are ignored; no input rows gives one
    row of NULLs (the plan downstream then produces no frames).
    """
    ok = F.lit(True)
    for c in EXTENT_COLS:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c))
    return (extents.filter(ok)
            .agg(F.min("minx").alias("minx"), F.max("maxx").alias("maxx"),
                 F.min("miny").alias("miny"), F.max("maxy").alias("maxy")))


def extent_format(order: str = "plain", integral: bool = False, prefix: str = "") -> Column:
    """Extent columns as space-separated text in ``order``.

    ``integral`` prints the coordinates as whole numbers (BIGINT text) and
    fails on a fraction; otherwise Spark's double text (``1.0E7`` style) is
    used. An extent with a NULL has no text.
    """
    cols = []
    for name in ORDERS[order]:
        c = F.col(prefix + name)
        if integral:
            c = F.when(c == F.floor(c), c.cast("bigint")).when(c.isNotNull(), F.raise_error(F.concat(
                F.lit("extent coordinate is not a whole number: "), c.cast("string"))).cast("bigint"))
        cols.append(c.cast("string"))
    return F.when(~F.exists(F.array(*cols), lambda c: c.isNull()), F.concat_ws(EXTENT_SEPARATOR, *cols))


def require_extent(extent: DataFrame, what: str = "pixels") -> DataFrame:
    """The extent, failing the query when it is empty (all NULL: no valid input).

    Lazy: the check runs in the executors when the extent is first
    evaluated, no extra job.
    """
    missing = F.col("minx").isNull() | F.col("maxx").isNull() | F.col("miny").isNull() | F.col("maxy").isNull()
    guard = F.when(missing, F.raise_error(F.lit(f"empty extent: no valid {what} to map")))
    return extent.select(*[F.coalesce(guard.cast("double"), F.col(c)).alias(c) for c in EXTENT_COLS])
