"""A mosaic that is filled scene by scene.

The store keeps, per covered cell, the overlap policy's mergeable state, in
one versioned table of frames. Adding scenes merges their states into the
frames they touch and writes those frames anew; other frames stay as they are.
The order of additions doesn't matter, and a scene that is already stored is
not added again.

Layout under the store's path (any file system Spark writes to):

* ``states/token=<token>``: the states of the frames that one addition wrote;
* ``frames/token=<token>``, ``scenes/token=<token>``: which frames and scenes these are;
* ``commits/<version>``: a small file that names the token. It is created
  last and only if it does not exist, so an addition counts entirely or not at
  all, and two writers never take the same version.

A writer that finds its version taken looks at what the other one changed. If
neither frames nor scenes are shared, it takes the next version; if some are,
the addition is refused (``CommitConflict``) and can be repeated.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.grid import FRAME_KEYS, GridSpec, grid_shape
from lodestar.operators.mosaic import OverlapPolicy, cell_states, finished, merged_states


class CommitConflict(RuntimeError):
    """Another writer changed the same frames or scenes meanwhile."""


class MosaicStore:
    """One store: its path, the grid (a one-row extent and a frame size) and the policy, the same at each use.

    ``order`` names the pixel columns, besides cell and value, that make up a
    scene's content: a scene that comes again with other pixels is refused.
    """

    def __init__(self, spark: SparkSession, path: str, policy: OverlapPolicy, extent: DataFrame,
                 spec: GridSpec = GridSpec(), scene: str = "scene", value: str = "v", order: Sequence[str] = ("acq",)):
        self.spark, self.path, self.policy, self.spec = spark, path.rstrip("/"), policy, spec
        self.scene, self.value, self.order = scene, value, tuple(order)
        shape = grid_shape(extent, spec).first()
        self.grid = [*shape[:4], float(spec.res), spec.width, spec.height]

    # ---- commits ----------------------------------------------------------

    def _file(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def commits(self) -> list[str | None]:
        """Tokens of the additions that count, by version (None: one that never ended its commit)."""
        fs, path = self._file("commits")
        if not fs.exists(path):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().isdigit())
        return [self._read(name) for name in names]

    def _read(self, name: str) -> str | None:
        fs, path = self._file("commits", name)
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if not text:
            return None
        entry = json.loads(text)
        if entry["grid"] != self.grid:
            raise ValueError(f"the store at {self.path} has another grid: {entry['grid']}, not {self.grid}")
        return entry["token"]

    def _commit(self, version: int, token: str) -> bool:
        """Take the version; False if another writer has it."""
        fs, path = self._file("commits", f"{version:010d}")
        if fs.exists(path):
            return False
        try:
            stream = fs.create(path, False)
        except Exception as taken:
            if "AlreadyExists" in str(taken):
                return False
            raise
        stream.write(bytearray(json.dumps({"token": token, "grid": self.grid}), "utf-8"))
        stream.close()
        return True

    # ---- reading ------------------------------------------------------------

    def _all(self, kind: str, tokens: Sequence[str | None]) -> DataFrame | None:
        """Rows of one kind of the tokens' tables, with ``_version``: one scan, whatever the number of additions."""
        live = [(token, version) for version, token in enumerate(tokens) if token is not None]
        if not live:
            return None
        rows = self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(
            *[f"{self.path}/{kind}/token={token}" for token, _ in live])
        # one narrow row per addition, which the driver lists already
        versions = self.spark.createDataFrame(live, "token string, _version int")
        return rows.join(F.broadcast(versions), "token").drop("token")

    def scenes(self) -> DataFrame | None:
        """Stored scenes with their content (pixels and a hash); None for an empty store."""
        return self._all("scenes", self.commits())

    def frame_versions(self, tokens: Sequence[str | None] | None = None) -> DataFrame | None:
        """(frame_row, frame_col, version): the addition that last wrote each frame."""
        frames = self._all("frames", self.commits() if tokens is None else tokens)
        return None if frames is None else frames.groupBy(*FRAME_KEYS).agg(F.max("_version").alias("version"))

    def states(self, tokens: Sequence[str | None] | None = None, of: DataFrame | None = None) -> DataFrame | None:
        """The current state of each covered cell (of the frames ``of``)."""
        tokens = self.commits() if tokens is None else tokens
        live = self.frame_versions(tokens)
        if live is None:
            return None
        if of is not None:
            live = live.join(of.select(*FRAME_KEYS), list(FRAME_KEYS), "left_semi")
        # one narrow row per frame, far fewer than cells: broadcast, so that no state is dealt anew
        live = F.broadcast(live.withColumnRenamed("version", "_version"))
        return self._all("states", tokens).join(live, [*FRAME_KEYS, "_version"], "left_semi").drop("_version")

    def mosaic(self) -> DataFrame | None:
        """The mosaic of all stored scenes, with the columns of ``mosaic_fill``; None for an empty store."""
        states = self.states()
        return None if states is None else finished(states, self.policy)

    # ---- adding -------------------------------------------------------------

    def add(self, placed: DataFrame) -> str | None:
        """Add the scenes of placed pixels (``pixel_to_frame``); the token, or None if all are stored already.

        A scene comes whole: one that is stored with other pixels is refused.
        Pixels without a value count for the content only; a scene without any
        pixel is not seen.
        """
        tokens = self.commits()
        content = F.sum(F.xxhash64("gx", "gy", self.value, *self.order).cast("decimal(38,0)")).cast("string")
        seen = placed.groupBy(F.col(self.scene).alias("scene")).agg(F.count("*").alias("pixels"), content.alias("content"))
        token = "t" + os.urandom(8).hex()  # a letter first: the value of a partition folder stays text
        stored = self._all("scenes", tokens)
        if stored is not None:
            old = stored.select(F.col("scene").alias("_s"), F.col("pixels").alias("_p"), F.col("content").alias("_c"))
            same = F.col("scene").eqNullSafe(F.col("_s"))
            other = F.concat(F.lit("scene is stored with other pixels: "), F.coalesce(F.col("scene").cast("string"), F.lit("NULL")))
            differs = (F.col("pixels") != F.col("_p")) | (F.col("content") != F.col("_c"))
            is_new = (F.when(F.col("_p").isNull(), F.lit(True)).when(differs, F.raise_error(other).cast("boolean"))
                      .otherwise(F.lit(False)))
            seen = seen.join(old, same, "left").filter(is_new).drop("_s", "_p", "_c")
        seen.write.parquet(f"{self.path}/scenes/token={token}")
        new = self.spark.read.parquet(f"{self.path}/scenes/token={token}")
        if new.isEmpty():
            return None
        fresh = placed.join(new.select(F.col("scene").alias("_s")), F.col(self.scene).eqNullSafe(F.col("_s")), "left_semi")
        states = cell_states(fresh, self.policy, self.spec, self.value)
        states.write.parquet(f"{self.path}/added/token={token}")
        added = self.spark.read.parquet(f"{self.path}/added/token={token}")
        added.select(*FRAME_KEYS).distinct().write.parquet(f"{self.path}/frames/token={token}")
        frames = self.spark.read.parquet(f"{self.path}/frames/token={token}")
        before = self.states(tokens, of=frames)
        both = added if before is None else added.unionByName(before)
        (merged_states(both, self.policy, self.spec).sortWithinPartitions(*FRAME_KEYS, "cell_row", "cell_col")
         .write.parquet(f"{self.path}/states/token={token}"))
        version = len(tokens)
        while not self._commit(version, token):
            self._check(self.commits()[version], frames, new)
            version += 1
        return token

    def _check(self, other: str | None, frames: DataFrame, scenes: DataFrame) -> None:
        """Refuse if the addition ``other`` changed some of these frames or holds some of these scenes."""
        if other is None:
            raise CommitConflict("another addition is being committed; add the scenes again")
        theirs = self.spark.read.parquet(f"{self.path}/frames/token={other}")
        if not theirs.join(frames, list(FRAME_KEYS), "left_semi").isEmpty():
            raise CommitConflict(f"addition {other} changed the same frames meanwhile; add the scenes again")
        theirs = self.spark.read.parquet(f"{self.path}/scenes/token={other}").select(F.col("scene").alias("_s"))
        if not theirs.join(scenes, F.col("scene").eqNullSafe(F.col("_s")), "left_semi").isEmpty():
            raise CommitConflict(f"addition {other} holds the same scenes; add the scenes again")
