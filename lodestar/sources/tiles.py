"""Rasters stored as tiles: one row per tile, each band a row-major array.

Tiles are the compact storage form -- one row and one position per
``width x height`` pixels instead of one row per pixel. ``tile_pixels``
turns them into the wide pixel table the mapping operators take;
``apply_tile_kernel`` runs a caller's own per-tile code on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def tile_pixels(tiles: DataFrame, bands: Sequence[str], width: int, height: int, res: float,
                keys: Sequence[str] = ("scene",), origin_x: str = "tile_minx",
                origin_y: str = "tile_maxy") -> DataFrame:
    """One row per pixel: ``keys, x, y`` (cell centres) and one column per band.

    Pixel ``i`` of a tile sits at column ``i % width`` and row ``i // width``
    from the tile's top-left corner (``origin_x``, ``origin_y``). A short
    array leaves the missing pixels out (no-data); more values than
    ``width * height``, or bands of different lengths, fail with the tile's
    keys. A narrow generator -- no shuffle.
    """
    sizes = [F.coalesce(F.array_size(b), F.lit(0)) for b in bands]
    wrong = sizes[0] > width * height
    for n in sizes[1:]:
        wrong = wrong | (n != sizes[0])
    where = F.concat_ws(" ", *[F.concat(F.lit(k + "="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys])
    zipped = F.arrays_zip(*[F.col(b).alias(b) for b in bands])
    # the check is part of the generator's input, so column pruning keeps it
    zipped = F.when(wrong, F.raise_error(F.concat(F.lit(
        f"tile does not hold {width} x {height} values in each band: "), where))).otherwise(zipped)
    px = tiles.select(*keys, origin_x, origin_y, F.posexplode(zipped).alias("_pos", "_px"))
    col = F.col("_pos") % F.lit(width)
    row = F.floor(F.col("_pos") / F.lit(width))
    r = F.lit(float(res))
    return px.select(
        *keys,
        (F.col(origin_x) + (col + F.lit(0.5)) * r).alias("x"),
        (F.col(origin_y) - (row + F.lit(0.5)) * r).alias("y"),
        *[F.col("_px").getField(b).alias(b) for b in bands])


def apply_tile_kernel(tiles: DataFrame, kernel: Callable, schema: StructType | str) -> DataFrame:
    """Run ``kernel(pyarrow.RecordBatch) -> pyarrow.RecordBatch`` on every batch of tiles.

    The escape hatch for per-tile code that column expressions cannot say
    (e.g. a convolution). It runs in the executors on Arrow batches
    (``mapInArrow``), never row by row; prefer column expressions whenever
    they can express the computation.
    """
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            yield kernel(batch)
    return tiles.mapInArrow(run, schema)
