"""Alteration mapping end to end: index -> extents -> grid -> mosaic -> binary map.

One lazy DataFrame plan. The only global step is the extent union (a
one-row partial/final aggregate, read back as a scalar subquery); the only
large shuffle is the mosaic's group-by on grid cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.crs import projection_of
from lodestar.functions.raster import DEFAULT_THRESHOLD, TransverseMercator, project_utm
from lodestar.operators.bands import apply_index
from lodestar.operators.extent import extent_union, require_extent, scene_extent
from lodestar.operators.blocks import pack_blocks
from lodestar.operators.grid import (GridSpec, frame_grid, frame_index, pixel_footprint, pixel_to_frame,
                                     unplaced_pixels)
from lodestar.operators.mosaic import (OverlapPolicy, dense_cells, dense_summary, frame_summary, mosaic_fill,
                                       threshold_cells)


class MineralMap:
    """The stages of one mapping plan. Each stage is built on first access,
    so asking for the frames does not analyse the mosaic."""

    def __init__(self, pixels: DataFrame, spec: GridSpec, index: Column | None, mask: Column | None,
                 overlap: str | OverlapPolicy, order: Sequence[str], threshold: float, scene: str,
                 pixel_size: float, extent: DataFrame | None, keep: list[str], index_dir: str, dense: bool = False,
                 footprint: bool = False):
        self.pixels, self.spec = pixels, spec
        self._index_expr, self._mask_expr = index, mask
        self.overlap, self.order, self.threshold = overlap, tuple(order), threshold
        self.scene, self.pixel_size, self._given_extent = scene, pixel_size, extent
        self.keep, self.index_dir, self.dense, self.footprint = keep, index_dir, dense, footprint

    @cached_property
    def index(self) -> DataFrame:
        """Valid index pixels: keep columns + ``v``."""
        return apply_index(self.pixels, index=self._index_expr, mask=self._mask_expr, keep=self.keep)

    @cached_property
    def scene_extents(self) -> DataFrame:
        return scene_extent(self.pixels, scene=self.scene, pixel_size=self.pixel_size)

    @cached_property
    def extent(self) -> DataFrame:
        """One row: the given extent, or the union of the scene extents.

        An empty extent (no valid pixels) fails the query instead of
        silently mapping nothing."""
        ext = self._given_extent if self._given_extent is not None else extent_union(self.scene_extents)
        return require_extent(ext)

    @cached_property
    def frames(self) -> DataFrame:
        return frame_grid(self.extent, self.spec)

    @cached_property
    def frame_index(self) -> DataFrame:
        return frame_index(self.frames, self.index_dir)

    @cached_property
    def placed(self) -> DataFrame:
        if self.footprint:
            return pixel_footprint(self.index, self.extent, self.spec, self.pixel_size, outside="clip")
        return pixel_to_frame(self.index, self.extent, self.spec, outside="clip")

    @cached_property
    def unplaced(self) -> DataFrame:
        """Index pixels outside the extent or without coordinates, with the reason."""
        return unplaced_pixels(self.index, self.extent)

    @cached_property
    def mosaic(self) -> DataFrame:
        return mosaic_fill(self.placed, self.spec, policy=self.overlap, order=self.order)

    @cached_property
    def binary(self) -> DataFrame:
        return threshold_cells(self.mosaic, self.threshold)

    @cached_property
    def summary(self) -> DataFrame:
        summary = frame_summary(self.binary)
        return dense_summary(summary, self.frames) if self.dense else summary

    @cached_property
    def blocks(self) -> DataFrame:
        """One row per frame: its values packed behind a validity bitmap."""
        return pack_blocks(self.binary, self.frames, self.spec)

    @cached_property
    def dense_cells(self) -> DataFrame:
        """Every cell of every frame, NULL where no valid pixel is."""
        return dense_cells(self.binary, self.frames, self.spec)


def mineral_map(pixels: DataFrame, spec: GridSpec = GridSpec(), *,
                index: Column | None = None, mask: Column | None = None,
                overlap: str | OverlapPolicy = "latest", order: Sequence[str] = ("acq",),
                threshold: float = DEFAULT_THRESHOLD, scene: str = "scene",
                pixel_size: float | None = None, extent: DataFrame | None = None,
                keep: Sequence[str] | None = None, index_dir: str = "", dense: bool = False,
                projection: TransverseMercator | str | None = None,
                lon: str = "lon", lat: str = "lat", footprint: bool = False) -> MineralMap:
    """Build the whole mapping plan over a wide pixel table.

    ``index``/``mask`` are Column expressions over the band columns
    (defaults: argillic normalized difference, vegetation mask). ``order``
    ranks overlapping pixels for the ``latest``/``first`` policies.
    ``extent`` may pass a known one-row extent (``minx, maxx, miny, maxy``)
    to skip the extra pass over the pixels; by default it is the union of the
    scenes' pixel footprints, masked pixels included (a scene's raster covers
    them as no-data). Pixels outside a given extent, or without coordinates,
    are in ``unplaced``. ``dense`` lists frames without pixels in the summary
    too. With ``projection`` (or the text of a coordinate system) the pixels'
    ``lon``/``lat`` are projected to ``x``/``y`` first, to the millimetre. With
    ``footprint`` a pixel fills every cell that its square of ``pixel_size``
    covers, and the policy may read the share covered, ``weight``.
    """
    if isinstance(projection, str):
        projection = projection_of(projection)
    if projection is not None:
        x, y = project_utm(lon, lat, projection)
        # computed in a projection, which shares the series' common terms (a generator doesn't), and pinned by
        # a one-element explode of the results: else every later use of x and y would repeat the series
        pixels = pixels.withColumns({"_x": F.round(x, 3), "_y": F.round(y, 3)})
        pixels = pixels.withColumn("_at", F.explode(F.array(F.struct("_x", "_y"))))
        pixels = pixels.withColumns({"x": F.col("_at._x"), "y": F.col("_at._y")}).drop("_at", "_x", "_y")
    pixel_size = float(spec.res if pixel_size is None else pixel_size)
    keep = list(keep) if keep is not None else [scene, "x", "y", *[c for c in order if c != scene]]
    keep = list(dict.fromkeys(keep))
    return MineralMap(pixels, spec, index, mask, overlap, order, threshold, scene,
                      pixel_size, extent, keep, index_dir, dense, footprint)
