"""Incremental catalog ingest with Structured Streaming.

New text files dropped into a directory are decoded with the same column
expressions as the batch load. Each micro-batch is split into accepted and
rejected rows and written under ``batch_id=<n>``. Partition overwrite makes
a replayed batch (after a restart or a lost executor) replace its own
output instead of duplicating it. Progress lives in a checkpoint in the
shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestar.functions.decode import DecodeResult, append_constants, apply_error_policy, decode_lines
from lodestar.session import shared_dir


def catalog_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming annotated decode of the catalog lines arriving in ``source_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return decode_lines(reader.load(source_dir))


def _batch_writer(accepted_path: str, rejected_path: str,
                  accepted_sink: Callable[[DataFrame, int], None] | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # one micro-batch, read twice
        try:
            res = apply_error_policy(batch, "quarantine")
            assert isinstance(res, DecodeResult)
            stored = append_constants(res.accepted)
            for df, path in ((stored, accepted_path), (res.rejected, rejected_path)):
                (df.withColumn("batch_id", F.lit(batch_id)).write
                 .mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id").parquet(path))
            if accepted_sink is not None:  # last: a batch that fails before is replayed without it
                accepted_sink(stored, batch_id)
        finally:
            batch.unpersist()
    return write


def start_catalog_ingest(spark: SparkSession, source_dir: str, accepted_path: str,
                         rejected_path: str, *, checkpoint: str | None = None,
                         available_now: bool = True, processing_time: str | None = None,
                         max_files_per_trigger: int | None = None,
                         accepted_sink: Callable[[DataFrame, int], None] | None = None,
                         name: str = "catalog_ingest") -> StreamingQuery:
    """Start the ingest. ``available_now`` processes what is there and stops.

    ``accepted_sink(df, batch_id)`` can also push accepted rows elsewhere,
    e.g. ``lambda df, _: jdbc_append(df, url, table)``. It runs after the
    files; a batch lost after it is replayed and calls it again, so it has to
    refuse a ``batch_id`` or keys that it has already taken.
    """
    checkpoint = checkpoint or shared_dir(spark, "streams", name)
    writer = (catalog_stream(spark, source_dir, max_files_per_trigger).writeStream
              .queryName(name)
              .option("checkpointLocation", checkpoint)
              .foreachBatch(_batch_writer(accepted_path, rejected_path, accepted_sink)))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
