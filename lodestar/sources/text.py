"""Line-oriented text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def catalog_scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per text line (``value STRING``) of a file, directory or glob.

    Files are split by ``spark.sql.files.maxPartitionBytes``, so one large
    file is read by many tasks. A missing path raises Spark's own
    ``AnalysisException``.
    """
    return spark.read.text(path)
