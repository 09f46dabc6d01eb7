"""Row counts: total, per partition, and the load report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``n`` = number of rows (partial counts per task, summed once)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def partition_counts(df: DataFrame, error: str | None = None) -> DataFrame:
    """Rows per partition of ``df`` as it is read: ``partition_id, n`` (and ``failed`` if ``error`` is named)."""
    failed = [F.count(F.col(error)).alias("failed")] if error else []
    return (df.groupBy(F.spark_partition_id().alias("partition_id"))
            .agg(F.count(F.lit(1)).alias("n"), *failed))


def sum_counts(counts: DataFrame) -> DataFrame:
    """One row: the per-partition counts added up (no partition: 0)."""
    names = [c for c in counts.columns if c != "partition_id"]
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def load_report(annotated: DataFrame, error: str = "error") -> DataFrame:
    """``attempted, rejected, accepted`` of an annotated decode, in one aggregate."""
    return annotated.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count(F.col(error)).alias("rejected"),
        F.count(F.when(F.col(error).isNull(), F.lit(1))).alias("accepted"),
    )
