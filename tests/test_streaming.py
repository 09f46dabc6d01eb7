"""Streaming ingest: same decode as batch, exactly one output per batch."""

import os
import tempfile

from lodestar.plans import fixtures as X
from lodestar.plans.catalog import load_catalog
from lodestar.streaming.catalog_stream import start_catalog_ingest


def test_stream_matches_batch_and_resumes(spark):
    root = tempfile.mkdtemp(prefix="stream-")
    src, acc, rej, ck = (os.path.join(root, d) for d in ("src", "acc", "rej", "ck"))
    lines = X.catalog_lines(X.reader(spark, "/root/testdata/sf0.001")).select("line")
    lines.repartition(3).write.text(os.path.join(src, "a"))
    q = start_catalog_ingest(spark, os.path.join(src, "*"), acc, rej, checkpoint=ck)
    q.awaitTermination(300)
    batch = load_catalog(lines, text_col="line")
    assert spark.read.parquet(acc).count() == batch.stored.count()
    assert spark.read.parquet(rej).count() == batch.rejected.count()
    # a second file arrives; a restarted query only picks up the new file
    lines.limit(10).write.text(os.path.join(src, "b"))
    q = start_catalog_ingest(spark, os.path.join(src, "*"), acc, rej, checkpoint=ck)
    q.awaitTermination(300)
    total = spark.read.parquet(acc).count() + spark.read.parquet(rej).count()
    assert total == lines.count() + 10


def test_stream_accepted_sink_sees_each_batch(spark):
    root = tempfile.mkdtemp(prefix="stream2-")
    src = os.path.join(root, "src")
    lines = X.catalog_lines(X.reader(spark, "/root/testdata/sf0.001")).select("line")
    lines.write.text(os.path.join(src, "a"))
    seen = []

    def sink(df, batch_id):
        seen.append((batch_id, df.count()))

    q = start_catalog_ingest(spark, os.path.join(src, "*"), os.path.join(root, "acc"),
                             os.path.join(root, "rej"), checkpoint=os.path.join(root, "ck"),
                             accepted_sink=sink, max_files_per_trigger=1)
    q.awaitTermination(300)
    assert sum(n for _, n in seen) == load_catalog(lines, text_col="line").stored.count()
    assert len(seen) >= 1
