"""Band groups, co-registration of band groups and index rasters.

A pixel table is wide: identifying columns (scene, x, y, acquisition time,
...) plus one column per band, named ``b1, b2, b3n, b4 ... b9``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.raster import argillic_index, vegetation_mask

# ASTER band columns of the visible/near-infrared and
# short-wave-infrared subsystems (b3 stands for b3n where only nadir exists).
VNIR_BANDS = ("b1", "b2", "b3n", "b3b", "b3")
SWIR_BANDS = ("b4", "b5", "b6", "b7", "b8", "b9")


def _present(df: DataFrame, bands: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [b for b in bands if b in have]


def select_bands(pixels: DataFrame, bands: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Key columns plus the listed bands that the table has (a pure projection,
    so only those columns reach the Parquet ``ReadSchema``)."""
    chosen = _present(pixels, bands)
    if not chosen:
        raise ValueError(f"none of the bands {list(bands)} in {pixels.columns}")
    return pixels.select(*keys, *chosen)


def export_vnir(pixels: DataFrame, keys: Sequence[str] = ("scene", "x", "y")) -> DataFrame:
    """The VNIR band group of every pixel."""
    return select_bands(pixels, VNIR_BANDS, keys)


def export_swir(pixels: DataFrame, keys: Sequence[str] = ("scene", "x", "y")) -> DataFrame:
    """The SWIR band group of every pixel."""
    return select_bands(pixels, SWIR_BANDS, keys)


def vnir_blocks(vnir: DataFrame, factor: int = 2, scene: str = "scene", x: str = "x", y: str = "y",
                px: str = "px", py: str = "py", acq: str = "acq") -> DataFrame:
    """VNIR pixels averaged into ``factor x factor`` blocks, with their number ``n`` and latest acquisition time."""
    times = [F.max(acq).alias(acq)] if acq in vnir.columns else []
    vbands = _present(vnir, VNIR_BANDS)
    f = F.lit(float(factor))
    return (vnir.select(scene, F.floor(F.col(x) / f).cast("bigint").alias(px), F.floor(F.col(y) / f).cast("bigint").alias(py),
                        *vbands, *([acq] if times else []))
            .groupBy(scene, px, py)
            .agg(*[F.avg(b).alias(b) for b in vbands], F.count(F.lit(1)).alias("n"), *times))


def unpaired_blocks(vnir: DataFrame, swir: DataFrame, factor: int = 2, scene: str = "scene", x: str = "x", y: str = "y",
                    px: str = "px", py: str = "py") -> DataFrame:
    """Cells that :func:`coregister` cannot pair: ``scene, px, py, has`` (``vnir`` or ``swir``), one row per cell.

    Cells with a NULL in their key never pair and are listed on each side.
    """
    blocks = vnir_blocks(vnir, factor, scene, x, y, px, py).select(scene, px, py, F.lit(True).alias("_vnir"))
    cells = swir.select(scene, px, py).distinct().withColumn("_swir", F.lit(True))
    both = blocks.join(cells, [scene, px, py], "full")
    return both.filter(F.col("_vnir").isNull() | F.col("_swir").isNull()).select(
        scene, px, py, F.when(F.col("_vnir").isNull(), F.lit("swir")).otherwise(F.lit("vnir")).alias("has"))


def coregister(vnir: DataFrame, swir: DataFrame, factor: int = 2,
               scene: str = "scene", x: str = "x", y: str = "y",
               px: str = "px", py: str = "py", acq: str = "acq",
               res: float | None = None) -> DataFrame:
    """Bring VNIR onto the coarser SWIR grid and pair the two per scene and cell.

    VNIR pixels are averaged into ``factor x factor`` blocks (15 m -> 30 m
    for ASTER), then inner-joined to SWIR on ``(scene, px, py)``. The
    aggregate is already hash-partitioned on the join keys, so only the SWIR
    side is shuffled for the join. The latest acquisition time of a block
    is carried if VNIR has one; with ``res`` (map units of a fine cell) the
    block's centre is added as ``x, y``, so the result can be mapped. Blocks and
    cells without a partner are left out; :func:`unpaired_blocks` lists them.
    """
    blocks = vnir_blocks(vnir, factor, scene, x, y, px, py, acq)
    sbands = [c for c in swir.columns if c not in (scene, px, py)]
    both = blocks.join(swir.select(scene, px, py, *sbands), [scene, px, py], "inner")
    if res is None:
        return both
    side = F.lit(float(res) * factor)
    return both.withColumns({x: (F.col(px) + F.lit(0.5)) * side, y: (F.col(py) + F.lit(0.5)) * side})


IndexFn = Callable[[], Column]


def apply_index(pixels: DataFrame, index: Column | None = None, mask: Column | None = None,
                keep: Sequence[str] | None = None, name: str = "v") -> DataFrame:
    """Index raster: ``keep`` columns plus ``name`` = the index, where ``mask`` holds.

    Defaults: the argillic normalized difference of b4/b6 and the vegetation
    mask ``b3 / b2 <= 1.35``. Pixels failing the mask are dropped (no-data);
    a NULL (zero denominator) or NaN index is NULL, i.e. no-data.
    """
    index = argillic_index() if index is None else index
    mask = vegetation_mask() if mask is None else mask
    cols = list(keep) if keep is not None else [c for c in pixels.columns]
    index = index.cast("double")
    return pixels.filter(mask).select(*cols, F.when(~F.isnan(index), index).alias(name))
