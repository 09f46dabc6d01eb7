"""Scene listing: the entries of a directory whose names end with a suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: scene files are HDF.
SCENE_SUFFIX = ".hdf"


def base_name(path: Column | str) -> Column:
    """Last segment of a path or URL."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(path, r"([^/]*)$", 1)


def scene_listing(spark: SparkSession, directory: str, suffix: str = SCENE_SUFFIX) -> DataFrame:
    """``name, path`` of the directory's entries whose name ends with ``suffix`` (case-sensitive).

    One level is listed, by the store's own directory listing; nothing is
    opened, so empty files are listed too. A plain file as ``directory`` is an
    error. The store filters the names; like any listing of one directory,
    theirs passes through the process that asks.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(directory)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.isFile(root):
        raise ValueError(f"scene_listing needs a directory, got a file: {directory}")
    if not fs.exists(root):
        raise FileNotFoundError(directory)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(fs.makeQualified(root), "*" + _glob_escape(suffix)))
    rows = [(status.getPath().toString(),) for status in found]
    return spark.createDataFrame(rows, "path string").select(base_name("path").alias("name"), "path")


def _glob_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in "*?[]{}\\" else ch)
    return "".join(out)
