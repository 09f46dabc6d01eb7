"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "lodestar", extra: dict | None = None) -> SparkSession:
    """Session for tests, benches and local runs.

    On a cluster the launcher owns the session; these are the settings the
    plans assume: UTC, AQE with partition coalescing and skew-join splitting,
    and no web UI.
    """
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # building a plan would otherwise record a Python call site (several
        # JVM round trips) for every Column function; only error text uses it
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only when
    neither is set in local mode -- local runs and tests -- a fresh local
    folder is created and registered as the checkpoint dir, so
    ``DataFrame.checkpoint()`` works too; on a cluster that is an error.
    Returns ``<root>/<parts...>``.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster job needs a shared "
                               "folder for checkpoints and staged tables")
        root = tempfile.mkdtemp(prefix="lodestar-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return "/".join([root.rstrip("/"), *parts]) if parts else root


def unique_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder name under :func:`shared_dir`."""
    base = shared_dir(spark)
    token = os.urandom(6).hex()
    return f"{base.rstrip('/')}/{name}-{token}"


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions (known while a plan is built, unlike the executors)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
