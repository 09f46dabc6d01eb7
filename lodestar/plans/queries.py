"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or data Spark derives from them), over
whole tables. Column names equal those of the SQL in
:mod:`lodestar.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import decode as D
from lodestar.functions import strings as S
from lodestar.functions.crs import projection_of
from lodestar.functions.raster import TransverseMercator, normalized_difference, project_utm
from lodestar.operators.bands import apply_index, coregister, export_swir, export_vnir, unpaired_blocks
from lodestar.operators.counts import partition_counts, row_count, sum_counts
from lodestar.operators.extent import extent_error, extent_format, extent_union, parse_extent, scene_extent
from lodestar.operators.grid import (GridSpec, empty_frames, frame_grid, frame_index,
                                     pixel_to_frame, scene_frame_join, unplaced_pixels)
from lodestar.operators.blocks import unpack_blocks
from lodestar.operators.mosaic import overlap_policy, weighted_mean
from lodestar.plans import fixtures as X
from lodestar.plans.catalog import load_catalog
from lodestar.plans.mineral_map import mineral_map
from lodestar.schema import CATALOG_SCHEMA
from lodestar.session import unique_dir
from lodestar.sinks.frames import block_sink, frame_sink, read_blocks, read_frames
from lodestar.sinks.jdbc import jdbc_frame, tolerant_write
from lodestar.sinks.mosaic_store import MosaicStore
from lodestar.sources.pixels import extent_from_files, write_pixels
from lodestar.sources.scenes import scene_listing
from lodestar.sources.text import catalog_scan
from lodestar.sources.tiles import apply_tile_kernel, tile_pixels

SPEC = GridSpec()
# Overlap order of the obs pixels: acquisition time, then line key, then scene.
OBS_ORDER = ("acq", "l_orderkey", "scene")
OBS_KEYS = ("scene", "x", "y", "acq", "l_orderkey")
FRAME_DIR = "/data/frames/"


def _t(spark: SparkSession, sf_dir: str) -> X.Reader:
    return X.reader(spark, sf_dir)


def _parts(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_p", S.quoted_split(F.col(text)))


def _field(i: int):
    return F.try_element_at(F.col("_p"), F.lit(i))


def _write_lines(spark: SparkSession, sf_dir: str) -> str:
    """Catalog lines written as a text directory in the shared folder."""
    path = unique_dir(spark, "catalog-text")
    X.catalog_lines(_t(spark, sf_dir)).select("line").write.text(path)
    return path


def _obs_map(spark: SparkSession, sf_dir: str, **kw):
    return mineral_map(X.observations_nodata(_t(spark, sf_dir)), SPEC, order=OBS_ORDER,
                       keep=OBS_KEYS, **kw)


# ---- sources -------------------------------------------------------------

def catalog_scan_q(spark, sf_dir):
    return catalog_scan(spark, _write_lines(spark, sf_dir))


def scene_listing_q(spark, sf_dir):
    """Scene entries of a folder written from the order table; those whose suffix has other letters are not listed."""
    path = unique_dir(spark, "scenes")
    X.scene_entries(_t(spark, sf_dir)).write.partitionBy("scene_file").parquet(path)
    return scene_listing(spark, path).select("name")


# ---- split and decode ----------------------------------------------------

def quoted_split_q(spark, sf_dir):
    df = X.short_lines(_t(spark, sf_dir))
    return df.select("event_id", F.posexplode(S.quoted_split("l")).alias("pos", "part")) \
             .select("event_id", (F.col("pos") + 1).alias("pos"), "part")


def quoted_split_nonempty_q(spark, sf_dir):
    df = X.short_lines(_t(spark, sf_dir))
    return df.select("event_id", F.posexplode(S.quoted_split_nonempty("l")).alias("pos", "item")) \
             .select("event_id", (F.col("pos") + 1).alias("pos"), "item")


def quoted_split_regex_q(spark, sf_dir):
    """A regular-expression separator of several characters."""
    df = X.short_lines(_t(spark, sf_dir)).select("event_id", F.replace("l", F.lit(","), F.lit(" ||  ")).alias("l"))
    return df.select("event_id", F.posexplode(S.quoted_split("l", r"\s*\|{2}\s+")).alias("pos", "part")) \
             .select("event_id", (F.col("pos") + 1).alias("pos"), "part")


def _decoded(spark, sf_dir) -> DataFrame:
    lines = X.catalog_lines(_t(spark, sf_dir))
    return D.decode_lines(lines, text_col="line", keep=("line_id",))


def typed_decode_q(spark, sf_dir):
    return D.apply_error_policy(_decoded(spark, sf_dir), "keep", keep=("line_id",))


def empty_numeric_default_q(spark, sf_dir):
    df = _parts(X.catalog_lines(_t(spark, sf_dir)), "line")
    return df.select("line_id",
                     D.empty_numeric_default(_field(7)).alias("timestamp_text"),
                     D.empty_numeric_default(_field(11)).alias("band_count_text"),
                     D.empty_numeric_default(_field(14)).alias("cloud_text"))


def char_decode_q(spark, sf_dir):
    df = _parts(X.catalog_lines(_t(spark, sf_dir)), "line")
    return df.select("line_id", D.char_decode(_field(1)).alias("satellite_char"),
                     D.char_decode(_field(7)).alias("timestamp_char"))


def boolean_decode_q(spark, sf_dir):
    labels = _t(spark, sf_dir)("labels")
    text = (F.when(F.col("quality") == 1, F.lit("True"))
            .when(F.col("toxic") == 1, F.lit("yes"))
            .otherwise(F.col("quality").cast("string")))
    return labels.select("doc_id", text.alias("flag_text")).withColumn("flag", D.boolean_decode("flag_text"))


def arity_check_q(spark, sf_dir):
    df = _parts(X.catalog_lines(_t(spark, sf_dir)), "line")
    return df.select("line_id", F.size("_p").alias("n_parts"),
                     D.arity_ok("_p").alias("arity_ok"))


def decode_error_policy_q(spark, sf_dir):
    return _decoded(spark, sf_dir).select("line_id", "error", "error_field")


def record_encode_q(spark, sf_dir):
    dec = D.apply_error_policy(_decoded(spark, sf_dir), "keep", keep=("line_id",))
    return dec.select("line_id", D.record_encode([f.name for f in CATALOG_SCHEMA.fields]).alias("record"))


def append_constants_q(spark, sf_dir):
    dec = D.apply_error_policy(_decoded(spark, sf_dir), "keep", keep=("line_id",))
    return D.append_constants(dec)


# ---- string functions and predicates --------------------------------------

def has_length_q(spark, sf_dir):
    df = _parts(X.catalog_lines(_t(spark, sf_dir)), "line")
    return df.select("line_id", F.size("_p").alias("n_parts"),
                     F.size(F.filter("_p", S.has_length)).alias("n_with_length"))


def trim_end_q(spark, sf_dir):
    p = _t(spark, sf_dir)("pages")
    return p.select("page_id", S.trim_end("url", ".html").alias("trimmed"))


def trim_head_q(spark, sf_dir):
    p = _t(spark, sf_dir)("pages")
    return p.select("page_id", S.trim_head("url", "https://").alias("trimmed"))


def trim_quotechar_q(spark, sf_dir):
    df = _parts(X.catalog_lines(_t(spark, sf_dir)), "line")
    return df.select("line_id", S.trim_quotechar(_field(1)).alias("satellite"),
                     S.trim_quotechar(_field(13)).alias("boundary"))


def output_path_q(spark, sf_dir):
    names = X.page_names(_t(spark, sf_dir)).select(
        "page_id", F.concat(F.lit("AST_"), F.col("page_id").cast("string"), F.lit("_"),
                            F.col("name"), F.lit(".hdf")).alias("scene_file"))
    return names.select("page_id", "scene_file",
                        S.output_path("scene_file", "/data/out/vnir/").alias("out_path"))


def token_list_q(spark, sf_dir):
    df = X.token_texts(_t(spark, sf_dir))
    return df.select("event_id", F.posexplode(S.token_list("txt")).alias("pos", "token")) \
             .select("event_id", (F.col("pos") + 1).alias("pos"), "token")


def suffix_filter_q(spark, sf_dir):
    return X.page_names(_t(spark, sf_dir)).filter(S.suffix_filter("name", ".html"))


def binary_threshold_q(spark, sf_dir):
    return _obs_map(spark, sf_dir).binary.select("gx", "gy", "frame_row", "frame_col", "v", "bit")


# ---- tiles ---------------------------------------------------------------------

def tile_pixels_q(spark, sf_dir):
    tiles = X.raster_tiles(_t(spark, sf_dir))
    return tile_pixels(tiles, ["value"], 8, 8, 500.0, keys=("vec_id", "scene"))


def _tile_edges(batch):
    """Strongest and mean edge of each 8 x 8 tile: the Laplacian of its inner pixels, for all tiles of the batch at once."""
    import numpy as np
    import pyarrow as pa

    values = batch.column("value")
    whole = np.diff(values.offsets.to_numpy()) == 64  # only whole tiles have the neighbours
    tiles = values.filter(pa.array(whole)).flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, 8, 8)
    inner = np.abs(4 * tiles[:, 1:-1, 1:-1] - tiles[:, :-2, 1:-1] - tiles[:, 2:, 1:-1] - tiles[:, 1:-1, :-2] - tiles[:, 1:-1, 2:])
    strongest, mean = np.full(len(whole), np.nan), np.full(len(whole), np.nan)
    strongest[whole], mean[whole] = inner.max(axis=(1, 2)), inner.mean(axis=(1, 2))
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), pa.array(np.round(strongest, 6), mask=~whole), pa.array(np.round(mean, 6), mask=~whole)],
        names=["vec_id", "max_edge", "mean_edge"])


def tile_kernel_q(spark, sf_dir):
    """A caller's per-tile kernel, a convolution (numpy on Arrow batches), through ``mapInArrow``."""
    tiles = X.raster_tiles(_t(spark, sf_dir)).select("vec_id", "value")
    return apply_tile_kernel(tiles, _tile_edges, "vec_id long, max_edge double, mean_edge double")


# ---- bands and index ---------------------------------------------------------

def export_vnir_q(spark, sf_dir):
    return export_vnir(X.observations(_t(spark, sf_dir)), keys=OBS_KEYS)


def export_swir_q(spark, sf_dir):
    return export_swir(X.observations(_t(spark, sf_dir)), keys=OBS_KEYS)


def coregister_q(spark, sf_dir):
    t = _t(spark, sf_dir)
    return coregister(X.vnir_pixels(t), X.swir_pixels(t)).select(
        "scene", "px", "py", "acq", "b2", "b3", "n", "b4", "b6")


def unpaired_blocks_q(spark, sf_dir):
    """Blocks and cells without a partner: VNIR lacks every 7th part, SWIR every 5th supplier pair."""
    t = _t(spark, sf_dir)
    return unpaired_blocks(X.vnir_pixels(t).filter(F.col("x") % 7 > 1), X.swir_pixels(t).filter(F.col("py") % 5 > 0))


def argillic_index_q(spark, sf_dir):
    return apply_index(X.observations_nodata(_t(spark, sf_dir)), keep=OBS_KEYS)


def user_index_q(spark, sf_dir):
    """A caller's own index, mask and overlap policy through the same plan."""
    m = mineral_map(X.observations_nodata(_t(spark, sf_dir)), SPEC,
                    index=normalized_difference("b6", "b4"), mask=F.col("b2") <= F.lit(1.05),
                    overlap="max", order=OBS_ORDER, keep=OBS_KEYS, threshold=0.5)
    return m.summary


# ---- geometry and grid ---------------------------------------------------------

def project_utm_q(spark, sf_dir):
    g = X.geo_points(_t(spark, sf_dir))
    e, n = project_utm("lon", "lat")
    return g.select("l_orderkey", "l_linenumber", "lon", "lat",
                    F.round(e, 3).alias("easting"), F.round(n, 3).alias("northing"))


def project_crs_q(spark, sf_dir):
    """Points in the zone that the text of each coordinate system describes (metres, and kilometres)."""
    g = X.geo_points(_t(spark, sf_dir))
    cols = []
    for name, text in X.COORDINATE_SYSTEMS.items():
        e, n = project_utm("lon", "lat", projection_of(text))
        cols += [F.round(e, 3).alias(f"e_{name}"), F.round(n, 3).alias(f"n_{name}")]
    return g.select("l_orderkey", "l_linenumber", *cols)


def scene_extent_q(spark, sf_dir):
    return scene_extent(X.observations(_t(spark, sf_dir)), pixel_size=SPEC.res)


def parse_extent_q(spark, sf_dir):
    ex = X.extent_texts(_t(spark, sf_dir))
    return ex.select("scene", *parse_extent("plain", "plain"), extent_error("plain").alias("error"),
                     *parse_extent("shell", "shell", prefix="s_"))


def extent_union_q(spark, sf_dir):
    return extent_union(scene_extent(X.observations(_t(spark, sf_dir)), pixel_size=SPEC.res))


def extent_format_q(spark, sf_dir):
    ex = X.extent_texts(_t(spark, sf_dir)).select("scene", *parse_extent("shell", "shell"))
    return ex.select("scene", extent_format("plain", integral=True).alias("plain_text"),
                     extent_format("shell", integral=True).alias("shell_text"))


def extent_format_full_q(spark, sf_dir):
    """Fractions are printed in full; an extent that did not parse has no text."""
    ex = X.extent_texts(_t(spark, sf_dir)).select("scene", *parse_extent("plain", "plain"))
    return ex.select("scene", extent_format("plain").alias("plain_text"), extent_format("shell").alias("shell_text"))


def frame_grid_q(spark, sf_dir):
    return _obs_map(spark, sf_dir).frames


def empty_frames_q(spark, sf_dir):
    return empty_frames(_obs_map(spark, sf_dir).frames, SPEC)


def frame_index_q(spark, sf_dir):
    return frame_index(_obs_map(spark, sf_dir).frames, FRAME_DIR)


def scene_frame_join_q(spark, sf_dir):
    m = mineral_map(X.strips(_t(spark, sf_dir)), SPEC, order=OBS_ORDER, keep=OBS_KEYS)
    return scene_frame_join(m.scene_extents, m.extent, m.frames, SPEC)


def scene_frame_levels_q(spark, sf_dir):
    """Narrow scenes and one over the whole grid of small frames."""
    spec = GridSpec(res=500.0, width=10, height=8)
    strips = X.strips(_t(spark, sf_dir))
    m = mineral_map(strips.unionByName(strips.withColumn("scene", F.lit(-1))), spec, order=OBS_ORDER, keep=OBS_KEYS)
    return scene_frame_join(m.scene_extents, m.extent, m.frames, spec)


def extent_from_files_q(spark, sf_dir):
    """Scene extents from the footers of a stored pixel table."""
    path = unique_dir(spark, "pixels")
    write_pixels(X.observations(_t(spark, sf_dir)).select(*OBS_KEYS), path)
    return extent_from_files(spark, path, pixel_size=SPEC.res, no_nan=True)


def pixel_to_frame_q(spark, sf_dir):
    obs = X.observations(_t(spark, sf_dir)).select(*OBS_KEYS)
    m = _obs_map(spark, sf_dir)
    return pixel_to_frame(obs, m.extent, SPEC)


def unplaced_pixels_q(spark, sf_dir):
    """Pixels that a given, smaller extent does not take; some have no coordinates."""
    obs = X.observations(_t(spark, sf_dir)).select(*OBS_KEYS)
    obs = obs.withColumn("y", F.when(F.col("l_orderkey") % 53 == 0, F.lit(None)).otherwise(F.col("y")))
    extent = extent_union(scene_extent(obs, pixel_size=SPEC.res)).select(
        "minx", (F.col("maxx") / 2).alias("maxx"), "miny", "maxy")
    return unplaced_pixels(obs, extent)


def mosaic_fill_q(spark, sf_dir):
    return _obs_map(spark, sf_dir).mosaic


def mosaic_fill_first_q(spark, sf_dir):
    return _obs_map(spark, sf_dir, overlap="first").mosaic


def mosaic_fill_mean_q(spark, sf_dir):
    m = _obs_map(spark, sf_dir, overlap="mean").mosaic
    return m.withColumn("v", F.round("v", 9))


def mosaic_fill_max_q(spark, sf_dir):
    return _obs_map(spark, sf_dir, overlap="max").mosaic


def mosaic_fill_min_q(spark, sf_dir):
    return _obs_map(spark, sf_dir, overlap="min").mosaic


def mosaic_fill_count_q(spark, sf_dir):
    return _obs_map(spark, sf_dir, overlap="count").mosaic


def mosaic_fill_weighted_q(spark, sf_dir):
    """A caller's own mergeable policy: the mean weighted by the pixel's scene."""
    m = mineral_map(X.observations_nodata(_t(spark, sf_dir)), SPEC, overlap=weighted_mean(F.col("scene")),
                    order=OBS_ORDER, keep=OBS_KEYS)
    return m.mosaic.withColumn("v", F.round("v", 9))


def footprint_fill_q(spark, sf_dir):
    """Pixels of twice the cell size fill every cell they cover; overlaps are averaged by covered area."""
    m = mineral_map(X.observations_nodata(_t(spark, sf_dir)), SPEC, overlap=weighted_mean("weight"), order=OBS_ORDER,
                    keep=OBS_KEYS, pixel_size=2.3 * SPEC.res, footprint=True)
    return m.mosaic.withColumn("v", F.round("v", 9))


# ---- counts --------------------------------------------------------------------

def row_count_q(spark, sf_dir):
    return row_count(X.catalog_lines(_t(spark, sf_dir)))


def partition_counts_q(spark, sf_dir):
    """Counts of each partition of the scan, with how many partitions and rows they make up."""
    counts = partition_counts(X.catalog_lines(_t(spark, sf_dir)))
    return counts.agg(F.sum("n").alias("n"), (F.count_distinct("partition_id") == F.count("*")).alias("once_each"))


def sum_reduce_q(spark, sf_dir):
    """Attempts and failures of each partition, added up."""
    total = sum_counts(partition_counts(_decoded(spark, sf_dir), error="error"))
    return total.select(F.col("n").alias("attempted"), F.col("failed").alias("rejected"),
                        (F.col("n") - F.col("failed")).alias("accepted"))


# ---- sinks -----------------------------------------------------------------------

def jdbc_append_q(spark, sf_dir):
    """The exact frame the JDBC sink appends (no database is reachable here)."""
    load = load_catalog(X.catalog_lines(_t(spark, sf_dir)), text_col="line", keep=("line_id",))
    return jdbc_frame(load.stored, extra=("line_id",))


def tolerant_write_q(spark, sf_dir):
    """Lines with failed ones, identical lines, lines that share a key, NULL keys and keys already stored."""
    t = _t(spark, sf_dir)
    res = tolerant_write(X.keyed_lines(t), text_col="line", key=("image_id",), keep=("line_id",),
                         existing_keys=X.stored_image_ids(t))
    status = F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    return res.flagged.select("line_id", status.alias("status"), "reason")


def frame_sink_q(spark, sf_dir):
    path = unique_dir(spark, "frames")
    binary = _obs_map(spark, sf_dir).binary
    frame_sink(binary, path)
    return read_frames(spark, path).select("gx", "gy", "frame_row", "frame_col", "v", "bit")


def frame_sink_dense_q(spark, sf_dir):
    """Every cell of every frame, written as one block per frame and read back."""
    path = unique_dir(spark, "frames-dense")
    block_sink(_obs_map(spark, sf_dir).blocks, path)
    return unpack_blocks(read_blocks(spark, path, SPEC), SPEC)


def frame_blocks_q(spark, sf_dir):
    """One row per frame; bitmaps and values as digests and sums."""
    def digest(name: str):
        return F.md5(F.array_join(F.transform(name, lambda x: x.cast("string")), ",")).alias(f"{name}_md5")

    total = F.round(F.aggregate("v", F.lit(0.0), lambda s, v: s + v), 6)
    return _obs_map(spark, sf_dir).blocks.select(
        "frame_row", "frame_col", "n_valid", digest("valid"), digest("hot"), digest("starts"), total.alias("v_sum"),
        F.try_element_at("v", F.lit(1)).alias("first_v"), F.try_element_at("v", F.lit(-1)).alias("last_v"))


def mosaic_incremental_q(spark, sf_dir):
    """Scenes added to a store in three parts, out of order and some of them twice."""
    m = _obs_map(spark, sf_dir)
    store = MosaicStore(spark, unique_dir(spark, "mosaic-store"), overlap_policy("latest", OBS_ORDER), m.extent, SPEC,
                        order=[c for c in OBS_ORDER if c != "scene"])
    placed = m.placed
    for scenes in ([5, 6, 7], [1, 2, 6], [2, 3, 4]):
        store.add(placed.filter(F.col("scene").isin(scenes)))
    return store.mosaic()


# ---- composed ----------------------------------------------------------------------

def load_catalog_q(spark, sf_dir):
    lines = catalog_scan(spark, _write_lines(spark, sf_dir))
    return load_catalog(lines, text_col="value").stored


def load_catalog_keep_q(spark, sf_dir):
    """Every line is stored; failed records hold default values."""
    return load_catalog(X.catalog_lines(_t(spark, sf_dir)), text_col="line", on_error="keep",
                        keep=("line_id",)).stored


def load_catalog_rejects_q(spark, sf_dir):
    return load_catalog(X.catalog_lines(_t(spark, sf_dir)), text_col="line", keep=("line_id",)).rejected


def mineral_map_q(spark, sf_dir):
    return _obs_map(spark, sf_dir).summary


def mineral_map_dense_q(spark, sf_dir):
    """The summary of all frames; the eastern part lies 600 km further east, so that frames between stay empty."""
    pixels = X.observations_gap(_t(spark, sf_dir))
    return mineral_map(pixels, SPEC, order=OBS_ORDER, keep=OBS_KEYS, dense=True).summary


def mineral_map_lonlat_q(spark, sf_dir):
    return mineral_map(X.lonlat_pixels(_t(spark, sf_dir)), SPEC, order=OBS_ORDER, keep=OBS_KEYS,
                       projection=TransverseMercator(), dense=True).summary


def mineral_map_from_bands_q(spark, sf_dir):
    """The two band groups, brought together and mapped."""
    t = _t(spark, sf_dir)
    both = coregister(X.vnir_pixels(t), X.swir_pixels(t), res=250.0)
    return mineral_map(both, SPEC, mask=F.col("b3") <= F.col("b2"), order=("acq", "scene"),
                       keep=("scene", "x", "y", "acq")).summary


QUERIES = {
    # sources
    "catalog_scan": catalog_scan_q,
    "scene_listing": scene_listing_q,
    # split / decode
    "quoted_split": quoted_split_q,
    "quoted_split_nonempty": quoted_split_nonempty_q,
    "quoted_split_regex": quoted_split_regex_q,
    "typed_decode": typed_decode_q,
    "empty_numeric_default": empty_numeric_default_q,
    "char_decode": char_decode_q,
    "boolean_decode": boolean_decode_q,
    "arity_check": arity_check_q,
    "decode_error_policy": decode_error_policy_q,
    "record_encode": record_encode_q,
    "append_constants": append_constants_q,
    # string functions
    "has_length": has_length_q,
    "trim_end": trim_end_q,
    "trim_head": trim_head_q,
    "trim_quotechar": trim_quotechar_q,
    "output_path": output_path_q,
    "token_list": token_list_q,
    # predicates
    "suffix_filter": suffix_filter_q,
    "binary_threshold": binary_threshold_q,
    # tiles
    "tile_pixels": tile_pixels_q,
    "tile_kernel": tile_kernel_q,
    # bands
    "export_vnir": export_vnir_q,
    "export_swir": export_swir_q,
    "coregister": coregister_q,
    "unpaired_blocks": unpaired_blocks_q,
    "argillic_index": argillic_index_q,
    # geometry / grid
    "project_utm": project_utm_q,
    "project_crs": project_crs_q,
    "scene_extent": scene_extent_q,
    "extent_from_files": extent_from_files_q,
    "parse_extent": parse_extent_q,
    "extent_union": extent_union_q,
    "extent_format": extent_format_q,
    "frame_grid": frame_grid_q,
    "empty_frames": empty_frames_q,
    "frame_index": frame_index_q,
    "scene_frame_join": scene_frame_join_q,
    "scene_frame_levels": scene_frame_levels_q,
    "pixel_to_frame": pixel_to_frame_q,
    "mosaic_fill": mosaic_fill_q,
    "mosaic_fill_first": mosaic_fill_first_q,
    "mosaic_fill_mean": mosaic_fill_mean_q,
    "mosaic_fill_max": mosaic_fill_max_q,
    "mosaic_fill_min": mosaic_fill_min_q,
    "mosaic_fill_count": mosaic_fill_count_q,
    "mosaic_fill_weighted": mosaic_fill_weighted_q,
    "footprint_fill": footprint_fill_q,
    "mosaic_incremental": mosaic_incremental_q,
    "unplaced_pixels": unplaced_pixels_q,
    "extent_format_full": extent_format_full_q,
    # aggregations
    "row_count": row_count_q,
    "partition_counts": partition_counts_q,
    "sum_reduce": sum_reduce_q,
    # sinks and user functions
    "jdbc_append": jdbc_append_q,
    "tolerant_write": tolerant_write_q,
    "frame_sink": frame_sink_q,
    "frame_sink_dense": frame_sink_dense_q,
    "frame_blocks": frame_blocks_q,
    "user_index": user_index_q,
    # composed
    "load_catalog": load_catalog_q,
    "load_catalog_keep": load_catalog_keep_q,
    "load_catalog_rejects": load_catalog_rejects_q,
    "mineral_map": mineral_map_q,
    "mineral_map_dense": mineral_map_dense_q,
    "mineral_map_lonlat": mineral_map_lonlat_q,
    "mineral_map_from_bands": mineral_map_from_bands_q,
}
