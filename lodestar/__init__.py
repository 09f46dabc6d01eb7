"""lodestar: satellite-image catalogs and alteration mapping as Spark DataFrame plans.

The main entry points::

    from lodestar import (build_session, catalog_scan, load_catalog, write_catalog,
                          mineral_map, GridSpec, tile_pixels, scene_listing)
"""

from lodestar.functions.decode import apply_error_policy, decode_lines, record_encode
from lodestar.functions.raster import (TransverseMercator, argillic_index, binary_threshold,
                                       normalized_difference, project_utm, vegetation_mask)
from lodestar.functions.strings import quoted_split, quoted_split_nonempty
from lodestar.operators.bands import apply_index, coregister, export_swir, export_vnir
from lodestar.operators.extent import extent_format, extent_union, parse_extent, scene_extent
from lodestar.operators.grid import (GridSpec, empty_frames, frame_grid, frame_index,
                                     pixel_to_frame, scene_frame_join)
from lodestar.operators.mosaic import frame_summary, mosaic_fill, threshold_cells
from lodestar.plans.catalog import load_catalog
from lodestar.plans.mineral_map import mineral_map
from lodestar.session import build_session
from lodestar.sinks.frames import frame_sink, materialise, read_frames
from lodestar.sinks.jdbc import jdbc_append, tolerant_write, write_catalog
from lodestar.sources.scenes import scene_listing
from lodestar.sources.text import catalog_scan
from lodestar.sources.tiles import apply_tile_kernel, tile_pixels
from lodestar.streaming.catalog_stream import start_catalog_ingest

__all__ = [
    "GridSpec", "TransverseMercator", "apply_error_policy", "apply_index", "apply_tile_kernel",
    "argillic_index", "binary_threshold", "build_session", "catalog_scan", "coregister",
    "decode_lines", "empty_frames", "export_swir", "export_vnir", "extent_format", "extent_union",
    "frame_grid", "frame_index", "frame_sink", "frame_summary", "jdbc_append", "load_catalog",
    "materialise", "mineral_map", "mosaic_fill", "normalized_difference", "parse_extent",
    "pixel_to_frame", "project_utm", "quoted_split", "quoted_split_nonempty", "read_frames",
    "record_encode", "scene_extent", "scene_frame_join", "scene_listing", "start_catalog_ingest",
    "threshold_cells", "tile_pixels", "tolerant_write", "vegetation_mask", "write_catalog",
]
