"""Derived inputs: catalog text, pixel tables, extent text and token text
built from the driver's tables, so every query's work grows with them.

Each function takes a reader ``table(name) -> DataFrame``; the equivalent
SQL (for the DuckDB check) lives in :mod:`lodestar.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Reader = Callable[[str], DataFrame]


def utm_text(zone: int, unit: str = "metre", factor: float = 1.0) -> str:
    """Text of a northern UTM zone's coordinate system on WGS 84, in any linear unit."""
    return (f'PROJCS["WGS 84 / UTM zone {zone}N", GEOGCS["WGS 84", DATUM["WGS_1984", SPHEROID["WGS 84", 6378137, 298.257223563]], '
            f'PRIMEM["Greenwich", 0], UNIT["degree", 0.0174532925199433]], PROJECTION["Transverse_Mercator"], '
            f'PARAMETER["latitude_of_origin", 0], PARAMETER["central_meridian", {6 * zone - 183}], PARAMETER["scale_factor", 0.9996], '
            f'PARAMETER["false_easting", {500000 / factor}], PARAMETER["false_northing", 0], UNIT["{unit}", {factor}]]')


COORDINATE_SYSTEMS = {"38n": utm_text(38), "39n": utm_text(39), "38n_km": utm_text(38, "kilometre", 1000)}


def reader(spark: SparkSession, sf_dir: str) -> Reader:
    """``name -> DataFrame`` over ``<sf_dir>/<name>.parquet``."""
    return lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def catalog_lines(table: Reader) -> DataFrame:
    """``line_id, line``: one 14-field catalog line per order, with quoted commas,
    empty numbers, bad numbers (``n/a``) and short lines mixed in."""
    k = F.col("o_orderkey")
    ts = F.when(k % 53 == 0, F.lit("")).otherwise(_s(k * 1000))
    bands = (F.when(k % 89 == 0, F.lit("n/a")).when(k % 31 == 0, F.lit(""))
             .otherwise(_s(k % 14)))
    cloud = (F.when(k % 97 == 0, F.lit(""))
             .otherwise(F.concat(F.lit(","), F.when(k % 41 == 0, F.lit("")).otherwise(_s(k % 100)))))
    line = F.concat(
        F.lit('"SAT,'), _s("o_orderstatus"), F.lit('",http://x/'), _s(k), F.lit(",L1,"),
        _s("o_orderpriority"), F.lit(",15m,http://x/i/"), _s(k), F.lit(","), ts,
        F.lit(",img"), _s("o_custkey"), F.lit(",p,name,"), bands, F.lit(',VNIR,"'),
        _s("o_custkey"), F.lit(" "), _s(k), F.lit(","), _s(F.col("o_custkey") + 1), F.lit(" "), _s(k),
        F.lit('"'), cloud)
    return table("orders").select(k.alias("line_id"), line.alias("line"))


def scene_entries(table: Reader) -> DataFrame:
    """``o_orderkey, scene_file``: orders dealt to scene files by month; every fifth month's suffix is upper-case."""
    month = F.date_format("o_orderdate", "yyyyMM")
    suffix = F.when(month.cast("int") % 5 == 0, F.lit(".HDF")).otherwise(F.lit(".hdf"))
    return table("orders").select("o_orderkey", F.concat(F.lit("AST_"), month, suffix).alias("scene_file"))


def keyed_lines(table: Reader) -> DataFrame:
    """``catalog_lines`` plus second copies of some lines: identical ones (every 7th order) and
    ones with another level but the same image (every 11th). ``image_id`` is the image of the
    customer, shared by the customer's orders; a tenth of the customers share one image."""
    base = catalog_lines(table).join(
        table("orders").select(F.col("o_orderkey").alias("line_id"), F.col("o_custkey").alias("_cust")), "line_id")
    hot = F.regexp_replace("line", r",img[0-9]+,", ",imgHOT,")
    line = F.when(F.col("_cust") % 10 == 0, hot).otherwise(F.col("line"))
    base = base.select("line_id", line.alias("line"))
    same = base.filter(F.col("line_id") % 7 == 0)
    other = base.filter(F.col("line_id") % 11 == 0).select(
        "line_id", F.replace(F.col("line"), F.lit(",L1,"), F.lit(",L2,")).alias("line"))
    return base.unionByName(same).unionByName(other)


def stored_image_ids(table: Reader) -> DataFrame:
    """Images that the target table is said to hold already."""
    return table("customer").filter(F.col("c_custkey") % 17 == 0).select(
        F.concat(F.lit("img"), _s("c_custkey")).alias("image_id"))


def short_lines(table: Reader) -> DataFrame:
    """``event_id, l``: short lines with one quoted comma-bearing field."""
    return table("events").select(
        "event_id",
        F.concat(_s("event_id"), F.lit(',"'), _s("event_type"), F.lit(","), _s("user_id"),
                 F.lit('",'), _s("props"), F.lit(","), _s("value")).alias("l"))


def observations(table: Reader) -> DataFrame:
    """Pixel table ``obs``: 7 overlapping scenes of 500 m pixels.

    ``scene, x, y, acq, l_orderkey, b2, b3, b4, b6``.
    """
    return table("lineitem").select(
        F.col("l_linenumber").alias("scene"),
        (F.col("l_partkey") * F.lit(500.0) + F.lit(250)).alias("x"),
        (F.col("l_suppkey") * F.lit(500.0) + F.lit(250)).alias("y"),
        F.col("l_shipdate").alias("acq"),
        "l_orderkey",
        (F.lit(1) + F.col("l_tax")).alias("b2"),
        (F.lit(1) + F.col("l_discount")).alias("b3"),
        (F.col("l_extendedprice") / F.lit(1000)).alias("b4"),
        F.col("l_quantity").alias("b6"),
    )


def observations_nodata(table: Reader) -> DataFrame:
    """``observations`` with no-data: NULL, NaN and zero-denominator (b6 = -b4) pixels."""
    k = F.col("l_orderkey")
    return observations(table).withColumn(
        "b6", F.when(k % 97 == 0, F.lit(None)).when(k % 101 == 0, F.lit(float("nan")))
        .when(k % 103 == 0, -F.col("b4")).otherwise(F.col("b6")))


def observations_gap(table: Reader) -> DataFrame:
    """``observations_nodata`` with a gap: pixels from 50 km east of the origin on lie 600 km further east."""
    x = F.col("x")
    return observations_nodata(table).withColumn("x", F.when(x >= 50000, x + F.lit(600000.0)).otherwise(x))


def strips(table: Reader) -> DataFrame:
    """``observations`` with narrow scenes (50 km strips), none of which touches every frame."""
    return observations(table).withColumn("scene", F.floor(F.col("x") / F.lit(50000.0)).cast("int"))


def lonlat_pixels(table: Reader) -> DataFrame:
    """``observations_nodata`` placed by longitude and latitude around the central meridian."""
    return observations_nodata(table).select(
        "scene", (F.lit(42) + (F.col("x") % 60000) / F.lit(10000.0)).alias("lon"),
        (F.col("y") % 85000 / F.lit(1000.0) - F.lit(20.0)).alias("lat"),
        "acq", "l_orderkey", "b2", "b3", "b4", "b6")


def geo_points(table: Reader) -> DataFrame:
    """Longitude/latitude points around the zone's central meridian."""
    return table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.lit(42) + (F.col("l_partkey") % 600) / F.lit(100.0)).alias("lon"),
        ((F.col("l_suppkey") % 85) - F.lit(20.0)).alias("lat"))


def vnir_pixels(table: Reader) -> DataFrame:
    """Fine-grid VNIR pixels ``scene, x, y, b2, b3`` (one row per scene and cell)."""
    return (table("lineitem")
            .groupBy(F.col("l_linenumber").alias("scene"), F.col("l_partkey").alias("x"),
                     F.col("l_suppkey").alias("y"))
            .agg(F.max("l_shipdate").alias("acq"), F.sum("l_quantity").cast("bigint").alias("b2"),
                 F.sum(F.round(F.col("l_discount") * 100)).cast("bigint").alias("b3")))


def swir_pixels(table: Reader) -> DataFrame:
    """Half-resolution SWIR pixels ``scene, px, py, b4, b6``."""
    return (table("lineitem")
            .groupBy(F.col("l_linenumber").alias("scene"),
                     F.floor(F.col("l_partkey") / F.lit(2.0)).cast("bigint").alias("px"),
                     F.floor(F.col("l_suppkey") / F.lit(2.0)).cast("bigint").alias("py"))
            .agg(F.sum(F.round("l_extendedprice")).cast("bigint").alias("b4"),
                 F.sum("l_quantity").cast("bigint").alias("b6")))


def extent_texts(table: Reader) -> DataFrame:
    """Per scene, its extent as text in plain and shell order; some plain texts are malformed
    (not a number, a doubled blank, too short) and some hold fractions."""
    lo_x, hi_x = _s(F.min("l_partkey")), _s(F.max("l_partkey"))
    lo_y, hi_y = _s(F.min("l_suppkey")), _s(F.max("l_suppkey"))
    return (table("lineitem").groupBy(F.col("l_linenumber").alias("scene"))
            .agg(F.when(F.col("scene") == 2, F.concat_ws(" ", lo_x, F.lit("bad"), lo_y, hi_y))
                 .when(F.col("scene") == 4, F.concat_ws(" ", lo_x, F.lit(""), hi_x, lo_y, hi_y))
                 .when(F.col("scene") == 5, F.concat_ws(" ", lo_x, hi_x, lo_y))
                 .when(F.col("scene") == 6, F.concat_ws(" ", F.concat(lo_x, F.lit(".25")), hi_x, lo_y, hi_y))
                 .otherwise(F.concat_ws(" ", lo_x, hi_x, lo_y, hi_y)).alias("plain"),
                 F.concat_ws(" ", lo_x, hi_x, hi_y, lo_y).alias("shell")))


def token_texts(table: Reader) -> DataFrame:
    """Tool-output-like lines of file names, some ending ``.TIF``."""
    return table("events").select(
        "event_id",
        F.concat(F.lit("f"), _s("event_id"), F.lit(".TIF note.txt "), _s("event_type"),
                 F.lit(".TIF g"), _s("user_id"), F.lit(".tif h.TIF")).alias("txt"))


def page_names(table: Reader) -> DataFrame:
    """``page_id, url, name``: the last path segment of each page URL
    (query string and fragment removed)."""
    path = F.regexp_replace(F.col("url"), r"[?#].*$", "")
    return table("pages").select("page_id", "url",
                                 F.regexp_extract(path, r"([^/]*)$", 1).alias("name"))


def raster_tiles(table: Reader) -> DataFrame:
    """The embedding vectors as 8 x 8 single-band tiles (``value``), laid out
    16 tiles per row from the top-left: ``vec_id, scene, tile_minx, tile_maxy, value``."""
    e = table("embeddings")
    return e.select(
        "vec_id", F.col("label").alias("scene"),
        ((F.col("vec_id") % 16) * F.lit(4000.0)).alias("tile_minx"),
        (F.lit(400000.0) - F.floor(F.col("vec_id") / F.lit(16)) * F.lit(4000.0)).alias("tile_maxy"),
        F.col("embedding").alias("value"))
