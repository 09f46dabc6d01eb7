"""Pixel tables on storage, and their extents from the files' statistics."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.extent import scene_extent
from lodestar.session import unique_dir


def write_pixels(pixels: DataFrame, path: str, scene: str = "scene", x: str = "x", y: str = "y",
                 mode: str = "errorifexists") -> None:
    """Write a pixel table with one directory per scene; a NaN coordinate fails the write.

    Without NaN the files' least and greatest coordinates can be trusted
    (:func:`extent_from_files`); a pixel without coordinates has NULL there.
    """
    def checked(name: str):
        c = F.col(name)
        return F.when(F.isnan(c.cast("double")), F.raise_error(F.lit(f"NaN in {name}: use NULL for no coordinate")).cast(
            pixels.schema[name].dataType)).otherwise(c)

    pixels.withColumns({x: checked(x), y: checked(y)}).write.partitionBy(scene).mode(mode).parquet(path)


def statistics_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer min, max and count from the file footers."""
    s = spark.newSession()
    s.conf.set("spark.sql.sources.useV1SourceList", "")
    s.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return s


def footer_statistics(spark: SparkSession, path: str, scene: str = "scene", x: str = "x", y: str = "y") -> DataFrame:
    """Per scene: least and greatest coordinates, rows, and rows with each coordinate; no row is read.

    The table is partitioned by scene. Belongs to :func:`statistics_session`;
    fails where a file lacks statistics.
    """
    pixels = statistics_session(spark).read.parquet(path)
    return pixels.groupBy(scene).agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"),
                                     F.count("*").alias("n"), F.count(x).alias("nx"), F.count(y).alias("ny"))


def _lacks_statistics(failed: Exception) -> bool:
    """Did the scan fail because a file has no min/max for a column."""
    cause = getattr(failed, "java_exception", None) or getattr(failed, "_origin", None)
    while cause is not None:
        if "No min/max found" in str(cause.getMessage()):
            return True
        cause = cause.getCause()
    return False


def extent_from_files(spark: SparkSession, path: str, scene: str = "scene", x: str = "x", y: str = "y",
                      pixel_size: float = 500.0, no_nan: bool = False) -> DataFrame:
    """:func:`~lodestar.operators.extent.scene_extent` of a Parquet table partitioned by scene, from its footers.

    The rows are read only where the footers can't tell: a file without
    statistics, a pixel without a coordinate (its other one must not count),
    or floating coordinates that may hold NaN, which statistics hide.
    ``no_nan`` says that they don't, as in tables that :func:`write_pixels` wrote.
    """
    pixels = spark.read.parquet(path)
    floats = [c for c in (x, y) if pixels.schema[c].dataType.typeName() in ("float", "double")]
    if floats and not no_nan:
        return scene_extent(pixels, scene, x, y, pixel_size)
    at = unique_dir(spark, "footers")
    try:
        footer_statistics(spark, path, scene, x, y).write.parquet(at)
    except (PySparkException, Py4JJavaError) as failed:
        if not _lacks_statistics(failed):
            raise
        return scene_extent(pixels, scene, x, y, pixel_size)
    found = spark.read.parquet(at)
    if not found.filter((F.col("nx") < F.col("n")) | (F.col("ny") < F.col("n"))).isEmpty():
        return scene_extent(pixels, scene, x, y, pixel_size)
    h = F.lit(float(pixel_size) / 2.0)
    return found.select(scene, *[e.alias(name) for e, name in (
        (F.col("x0").cast("double") - h, "minx"), (F.col("x1").cast("double") + h, "maxx"),
        (F.col("y0").cast("double") - h, "miny"), (F.col("y1").cast("double") + h, "maxy"))])
