"""Merkle dataset manifest: binary hash trees per group and over the groups, in van Emde Boas layout.

Rows are leaves, ascending by key within their group. Every two consecutive
nodes (a last one alone) give their parent until one is left, the group's
subroot; the subroots, ordered by group, give the root the same way.

The leaves of a group are cut into aligned blocks of 2^HEIGHT. A block's
subtree is one binary value in van Emde Boas layout: the upper half of its
levels first, then each subtree below, both again split at half height. The
place of a node is computed from its depth and index (``addresses``), for
writing the nodes and for reading the siblings of a leaf. The block roots are
the leaves of the next stage, until a group has one block; the table of
stages is the manifest. Proofs come down the same way: each stage hands its
path to the root on to the blocks below it.

No group passes through one task: places come from a range sort and the
counts of its runs, blocks hold 2^HEIGHT rows, and a stage is 2^HEIGHT times
smaller than the one below it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import shuffle_width, staged

HEIGHT = 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ALONE, RIGHT, LEFT = b"\x00", b"\x01", b"\x02"  # a path's step: no sibling, sibling to the right, to the left
STEP = 33
BLOCK_SCHEMA = ("g string, block long, total long, n int, levels int, root binary, nodes binary, "
                "ids array<string>, claims array<binary>")


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (binary) of the values: ``-`` for null, else UTF-8 byte count, ``:``, text (integers decimal)."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def group_key(group: Column) -> Column:
    """Text that orders groups bytewise, null first, and tells null from an empty text."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` in the van Emde Boas layout of a tree of ``levels`` levels."""
    at = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = levels - top
        tree = index >> (depth - top)
        at += (1 << top) - 1 + tree * ((1 << below) - 1)
        index = index & ((1 << (depth - top)) - 1)
        levels, depth = below, depth - top
    return at


@lru_cache(maxsize=32)
def _places(levels: int) -> list[np.ndarray]:
    """Byte offsets of all nodes of a tree of ``levels`` levels, by depth."""
    return [addresses(levels, d, np.arange(1 << d)) * 32 for d in range(levels)]


def build_block(leaves: Sequence[bytes], height: int | None = None) -> tuple[int, bytes, bytes]:
    """(levels above the leaves, root, nodes) of a block; without ``height`` up to its only root."""
    if height is None:
        height = max(0, len(leaves) - 1).bit_length()
    places = _places(height + 1)
    nodes = bytearray(32 * ((2 << height) - 1))
    level = list(leaves)
    for depth in range(height, -1, -1):
        for digest, at in zip(level, places[depth].tolist()):
            nodes[at:at + 32] = digest
        if depth:
            hexes = [d.hex() for d in level]
            level = [sha256("".join(hexes[i:i + 2]).encode()).digest() for i in range(0, len(hexes), 2)]
    return height, bytes(level[0]), bytes(nodes)


def sibling_path(nodes: bytes, height: int, n: int, leaf: int) -> bytes:
    """Steps from a leaf of a block of ``n`` leaves to the block's root."""
    places, out, count = _places(height + 1), [], n
    for depth in range(height, 0, -1):
        other = leaf ^ 1
        if other < count:
            at = int(places[depth][other])
            out.append((RIGHT if other > leaf else LEFT) + nodes[at:at + 32])
        else:
            out.append(ALONE + bytes(32))
        leaf, count = leaf >> 1, (count + 1) >> 1
    return b"".join(out)


def fold(digest: str, steps: Sequence[tuple[bytes, str]]) -> str:
    """Root (hex) that a leaf digest (hex) gives along the steps (side, sibling hex)."""
    for side, sibling in steps:
        text = digest if side == ALONE else digest + sibling if side == RIGHT else sibling + digest
        digest = sha256(text.encode()).hexdigest()
    return digest


def steps_of(path: bytes) -> list[tuple[bytes, str]]:
    return [(path[k:k + 1], path[k + 1:k + STEP].hex()) for k in range(0, len(path), STEP)]


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Staged rows with ``pos`` (place in group ``g`` by ``order``) and ``total`` (rows of the group).

    A range sort numbers the rows of each partition; the sums of the runs
    (group, partition) before them make the numbers places in the group.
    """
    sort = ["g", *order]
    ordered = (rows.repartitionByRange(shuffle_width(rows.sparkSession), *sort).sortWithinPartitions(*sort)
               .withColumn("_at", F.monotonically_increasing_id()))
    ordered = staged(ordered, "merkle-sorted").withColumn("_part", F.shiftright("_at", 33))
    runs = ordered.groupBy("g", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy("g")
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("g").alias("_g"), F.col("_part").alias("_p"),
                       (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
                       F.sum("_n").over(group).alias("total"))
    return (ordered.join(staged(runs, "merkle-runs"), (F.col("g") == F.col("_g")) & (F.col("_part") == F.col("_p")))
            .withColumn("pos", F.col("_at") + F.col("_base")).drop("_at", "_part", "_g", "_p", "_base"))


def stages(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Tables of blocks from the leaves (g, pos, total, digest, id, claim) up to one block a group."""
    out, most = [], 1 << height

    def block(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos", kind="stable")
        total = int(part["total"].iloc[0])
        levels, root, nodes = build_block(part["digest"].tolist(), None if total <= most else height)
        return pd.DataFrame({
            "g": [part["g"].iloc[0]], "block": [int(part["pos"].iloc[0]) >> height], "total": [total], "n": [len(part)],
            "levels": [levels], "root": [root], "nodes": [nodes], "ids": [part["id"].tolist()],
            "claims": [part["claim"].tolist()]})

    while True:
        blocks = nodes.groupBy("g", F.shiftright("pos", height).alias("_b")).applyInPandas(block, BLOCK_SCHEMA)
        out.append(staged(blocks, f"merkle-stage{len(out)}"))
        if (out[-1].agg(F.max("total")).first()[0] or 0) <= most:
            return out
        count = F.shiftright(F.col("total") + (most - 1), height)  # blocks of the group
        nodes = out[-1].where(F.col("total") > most).select(
            "g", F.col("block").alias("pos"), count.alias("total"), F.col("root").alias("digest"),
            F.lit(None).cast("string").alias("id"), F.lit(None).cast("binary").alias("claim"))


def _subroots(of: Sequence[DataFrame], height: int) -> DataFrame:
    """(g, root): the root of each group's last, only block."""
    tops = [s.where(F.col("total") <= 1 << height).select("g", "root") for s in of]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


@dataclass
class Manifest:
    """``groups``: the stages of the groups' trees, lowest first; ``top``: those of the tree over the subroots.

    A stage has one row per block: g (group key), block, total (nodes of its
    group in this stage), n, levels, root and nodes (van Emde Boas layout);
    the lowest also holds the ids of its rows and the digests claimed for them.
    """
    groups: list[DataFrame]
    top: list[DataFrame]
    height: int = HEIGHT

    def subroots(self) -> DataFrame:
        return _subroots(self.groups, self.height)

    def root(self) -> DataFrame:
        """One row (root); none for an empty table."""
        return _subroots(self.top, self.height).select("root")


def manifest(rows: DataFrame, id: str = "id", group: str = "g", digest: str = "digest",
             claim: str | None = None, height: int = HEIGHT) -> Manifest:
    """Build the trees of rows (group key text, id, 32-byte digest, optionally a claimed digest).

    ``height`` is that of a block: 2^height leaves.
    Leaves ascend by id (null first), equal ids by digest; repeated rows are
    leaves of their own. No rows: no blocks and no root.
    """
    claimed = F.col(claim) if claim else F.lit(None).cast("binary")
    thin = staged(rows.select(F.col(group).alias("g"), F.col(id).alias("key"), F.col(digest).alias("digest"),
                              claimed.alias("claim"), F.monotonically_increasing_id().alias("rid")), "merkle-leaves")
    leaves = ranked(thin, ["key", "digest", "rid"]).select(
        "g", "pos", "total", "digest", F.col("key").cast("string").alias("id"), "claim")
    groups = stages(leaves, height)
    subroots = _subroots(groups, height).select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("root").alias("digest"))
    top = stages(ranked(staged(subroots, "merkle-subroots"), ["key"]).select(
        "g", "pos", "total", "digest", F.col("key").alias("id"), F.lit(None).cast("binary").alias("claim")), height)
    return Manifest(groups, top, height)


def _descend(stage: DataFrame, paths: DataFrame, last: bool, height: int) -> DataFrame:
    """Paths of the nodes of a stage: (g, pos, path, subroot, top), and the ids of the top tree's lowest stage."""
    def children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                own = bytes(row.nodes)
                yield pd.DataFrame({
                    "g": [i if last else row.g for i in row.ids],
                    "pos": [0 if last else (int(row.block) << height) + i for i in range(row.n)],
                    "path": [sibling_path(own, row.levels, row.n, i) + row.path for i in range(row.n)],
                    "subroot": [own[a:a + 32] for a in _places(row.levels + 1)[row.levels][:row.n].tolist()]
                    if last else [row.subroot] * row.n,
                    "top": [row.top] * row.n})

    return _with_paths(stage, paths).mapInPandas(
        children, "g string, pos long, path binary, subroot binary, top binary")


def _with_paths(stage: DataFrame, paths: DataFrame) -> DataFrame:
    p = paths.select(F.col("g").alias("_g"), F.col("pos").alias("_pos"), "path", "subroot", "top")
    return stage.join(p, (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_pos"))).drop("_g", "_pos")


def proofs(m: Manifest) -> DataFrame:
    """One row per leaf: id (text), leaf, subroot, root, proof_sha256, folded_root (hex), verified.

    The proof is the SHA-256 of the leaf's siblings in hex, from the leaf up
    through its group's tree and the tree over the subroots. The root is
    folded anew from the claimed digest (the stored one where none is
    claimed) along the stored siblings.
    """
    only = m.top[-1].select("g", F.col("block").alias("pos"), F.lit(b"").alias("path"),
                            F.lit(None).cast("binary").alias("subroot"), F.col("root").alias("top"))
    paths = only
    for k in range(len(m.top) - 1, -1, -1):
        paths = staged(_descend(m.top[k], paths, k == 0, m.height), f"merkle-top-paths{k}")
    begin = paths  # one path per group, for its last, only block; that block lies in some stage
    for k in range(len(m.groups) - 1, 0, -1):
        here = staged(_descend(m.groups[k], paths, False, m.height), f"merkle-paths{k}")
        paths = here.unionByName(begin.join(  # groups that end in a lower stage start there
            here.select(F.col("g").alias("_g")).distinct(), F.col("g") == F.col("_g"), "left_anti"))

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                nodes, above = bytes(row.nodes), steps_of(bytes(row.path))
                above_hex = "".join(s for side, s in above if side != ALONE)
                leaves = [nodes[a:a + 32].hex() for a in _places(row.levels + 1)[row.levels][:row.n].tolist()]
                top, proof, folded = bytes(row.top).hex(), [], []
                for i, (leaf, claim) in enumerate(zip(leaves, row.claims)):
                    steps = steps_of(sibling_path(nodes, row.levels, row.n, i))
                    siblings = "".join(s for side, s in steps if side != ALONE) + above_hex
                    proof.append(sha256(siblings.encode()).hexdigest())
                    folded.append(fold(fold(leaf if claim is None else bytes(claim).hex(), steps), above))
                yield pd.DataFrame({"id": list(row.ids), "leaf": leaves, "subroot": bytes(row.subroot).hex(), "root": top,
                                    "proof_sha256": proof, "folded_root": folded, "verified": [f == top for f in folded]})

    return _with_paths(m.groups[0], paths).mapInPandas(
        report, "id string, leaf string, subroot string, root string, proof_sha256 string, "
                "folded_root string, verified boolean")


def audit(docs: DataFrame, claims: Mapping[str, Column] | None = None, where: Column | None = None,
          columns: Sequence[str] = COLUMNS, group: str = "lang", doc_id: str = "doc_id",
          height: int = HEIGHT) -> DataFrame:
    """Manifest of ``docs`` and the check of every row against it, as :func:`proofs` gives it, by ``doc_id``.

    ``claims`` replaces columns by what another party presents for the rows
    ``where`` holds; such rows verify only if nothing differs. Null values
    have a leaf text of their own, null groups are a group (the first), null
    ids come first and repeated rows are leaves of their own; other columns
    are ignored. No rows give no rows.
    """
    stored = leaf_digest([F.col(c) for c in columns])
    claim = F.lit(None).cast("binary")
    if claims:
        presented = leaf_digest([claims.get(c, F.col(c)) for c in columns])
        claim = F.when(where, presented) if where is not None else presented
    rows = docs.select(group_key(F.col(group)).alias("g"), F.col(doc_id).alias("id"), stored.alias("digest"),
                       claim.alias("claim"))
    out = proofs(manifest(rows, claim="claim", height=height))
    return out.select(F.col("id").cast(docs.schema[doc_id].dataType).alias(doc_id), "leaf", "subroot", "root",
                      "proof_sha256", "folded_root", "verified")
