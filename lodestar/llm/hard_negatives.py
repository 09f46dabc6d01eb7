"""Hard negatives by anchor-clustered shared lists (MAXIMUS-style exact search).

Anchors are clustered by direction (centroids from a bounded sample of them)
and dealt into slices of a cluster. A slice shares one list of candidates,
sorted once by an upper bound: a candidate at angle t from the slice's centre
scores at most |anchor| * |candidate| * cos(t - b) with any member, b being the
largest angle of a member. Every member walks the list from the top until the
bound falls below the score it still needs, which certifies its result.

Candidates are dealt into blocks of their own clusters, and every pair of a
slice and a block is a task of its own. The blocks of the slice's own cluster
are walked first; what they give is the score that members need from the
others. Scores are integers: inner products of the components floor(scale * x).

First the positives of each anchor are found (the best other rows of its
label), then, for the window of scores below each positive, the best rows of
other labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import staged

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95    # a negative's score as per cent of the positive's
SLICE = 512           # anchors of a slice, and on average of a cluster
BLOCK = 8192          # candidates of a block
STRIP = 256           # candidates of a list that are scored at once
SAMPLE = 8192         # anchors that the centroids are learnt from
SLACK = 1e-6          # of the bound's cosine, far above its rounding errors
NONE = -(1 << 62)     # a score below any other
FOUND = "arid long, slot int, score long, id long, rid long"


def learn_centroids(vectors: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids of up to ``k`` direction clusters (spherical k-means from spread-out rows)."""
    unit = vectors / np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-300)
    centroids = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
    for _ in range(rounds):
        near = np.argmax(unit @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, unit)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(length > 0, sums / np.maximum(length, 1e-300), centroids)
    return centroids


def _angles(rows: np.ndarray, length: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angles of rows to a centre; 0 for a zero row."""
    norm = length * math.sqrt(float(centre @ centre))
    cosine = np.divide(rows @ centre, norm, out=np.ones(len(rows)), where=norm > 0)
    return np.arccos(np.clip(cosine, -1, 1))


def shared_list(anchors: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): candidates by descending bound; |anchor| * bound is at least any member's score."""
    la, lc = (np.sqrt((m * m).sum(axis=1)) for m in (anchors, candidates))
    centre = np.divide(anchors, la[:, None], out=np.zeros_like(anchors), where=la[:, None] > 0).sum(axis=0)
    widest = _angles(anchors, la, centre).max() if centre.any() else math.pi
    bounds = lc * (np.cos(np.maximum(0.0, _angles(candidates, lc, centre) - widest)) + SLACK)
    order = np.argsort(-bounds, kind="stable")
    return order, bounds[order]


def best_of(pair: np.ndarray, score: np.ndarray, id: np.ndarray, rid: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` entries of each pair: higher scores first, then smaller ids."""
    order = np.lexsort((rid, id, -score, pair))
    pairs = pair[order]
    start = np.r_[True, pairs[1:] != pairs[:-1]]
    rank = np.arange(len(pairs)) - np.maximum.accumulate(np.where(start, np.arange(len(pairs)), 0))
    return order[rank < k]


def _matrix(q: pd.Series) -> np.ndarray:
    return np.array(q.to_list(), np.float64).reshape(len(q), -1)


def walk(anchors: pd.DataFrame, candidates: pd.DataFrame, k: int, same_label: bool) -> pd.DataFrame:
    """The members' best ``k`` candidates for each of their score windows, among these candidates.

    Anchors: arid, label, q, and the lists lo, hi, need (least and greatest
    score of each window, and the k-th best score known elsewhere).
    Candidates: rid, id, label, q.
    """
    none = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("arid", "slot", "score", "id", "rid")})
    if not len(anchors) or not len(candidates):
        return none
    a, c = _matrix(anchors["q"]), _matrix(candidates["q"])
    order, bounds = shared_list(a, c)
    length = np.sqrt((a * a).sum(axis=1))
    exact = float(length.max()) * math.sqrt(float((c * c).sum(axis=1).max())) < 2.0 ** 53  # sums of products, too
    lo, hi, need = (np.array(anchors[x].to_list(), np.int64) for x in ("lo", "hi", "need"))
    floors = np.where(lo <= hi, np.maximum(lo, need), np.iinfo(np.int64).max)
    slots = floors.shape[1]
    arid, alabel = anchors["arid"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64)
    crid, cid, clabel = (candidates[x].to_numpy(np.int64) for x in ("rid", "id", "label"))
    pair, score, at = (np.zeros(0, np.int64) for _ in range(3))
    for start in range(0, len(order), STRIP):
        rows = order[start:start + STRIP]
        active = np.flatnonzero(floors.min(axis=1) <= length * bounds[start] + 1)
        if not len(active):
            break  # certified: no later candidate can reach what any member still needs
        if exact:
            s = np.rint(a[active] @ c[rows].T).astype(np.int64)
        else:
            s = np.array(anchors["q"].iloc[active].map(lambda v: [int(x) for x in v]).to_list(), object) @ np.array(
                candidates["q"].iloc[rows].map(lambda v: [int(x) for x in v]).to_list(), object).T
            s = s.astype(np.int64)
        fits = (alabel[active][:, None] == clabel[rows][None, :]) == same_label
        fits &= arid[active][:, None] != crid[rows][None, :]
        new = [(pair, score, at)]
        for slot in range(slots):
            i, j = np.nonzero(fits & (s >= floors[active, slot][:, None]) & (s <= hi[active, slot][:, None]))
            new.append((active[i] * slots + slot, s[i, j], rows[j]))
        if sum(len(n[0]) for n in new[1:]):
            pair, score, at = (np.concatenate(x) for x in zip(*new))
            keep = best_of(pair, score, cid[at], crid[at], k)
            pair, score, at = pair[keep], score[keep], at[keep]
            full = np.flatnonzero(np.bincount(pair, minlength=floors.size) == k)
            if len(full):
                last = np.searchsorted(pair, full, side="right") - 1  # kept entries are sorted by pair, best first
                floors.ravel()[full] = np.maximum(floors.ravel()[full], score[last])
    if not len(pair):
        return none
    return pd.DataFrame({"arid": arid[pair // slots], "slot": pair % slots, "score": score, "id": cid[at], "rid": crid[at]})


def quantised(vectors: DataFrame, anchor: Column, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """Staged rows that take part: rid, id, label, q (floor(scale * x)), dim, anchor."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                          F.col(vector).alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
                      & F.coalesce(finite, F.lit(False)))
    rows = rows.withColumn("q", F.transform("v", lambda x: F.floor(x.cast("double") * scale)))
    size = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return staged(rows.where(size < float(1 << 62)).select(
        F.monotonically_increasing_id().alias("rid"), "id", "label", "q", F.size("q").alias("dim"), "anchor"), "neg-rows")


def clustered(rows: DataFrame, seed: int = 11) -> DataFrame:
    """Staged rows with ``cluster``: the nearest centroid of the anchors' clusters of their dimension."""
    anchors = rows.where("anchor")
    per = math.ceil(anchors.count() / SLICE)
    sample = anchors.orderBy(F.xxhash64("id", F.lit(seed)), "rid").limit(SAMPLE).select("q", "dim").toPandas()
    centroids = {int(dim): learn_centroids(_matrix(part["q"]), max(1, math.ceil(per * len(part) / len(sample))))
                 for dim, part in sample.groupby("dim") if dim > 0}

    @F.pandas_udf("int")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for q in batches:
            out, dims = np.zeros(len(q), np.int64), q.map(len).to_numpy()
            for dim in np.unique(dims):
                if int(dim) in centroids:
                    these = np.flatnonzero(dims == dim)
                    out[these] = np.argmax(_matrix(q.iloc[these]) @ centroids[int(dim)].T, axis=1)
            yield pd.Series(out)

    return staged(rows.withColumn("cluster", nearest("q")), "neg-clustered")


def dealt(rows: DataFrame, size: int, no: str) -> tuple[DataFrame, DataFrame]:
    """Rows dealt into parts of about ``size`` within (dim, cluster), numbered ``no`` in their dimension; parts per dimension."""
    groups = rows.groupBy("dim", "cluster").agg(F.ceil(F.count("*") / F.lit(float(size))).cast("int").alias("_parts"))
    before = Window.partitionBy("dim").orderBy("cluster").rowsBetween(Window.unboundedPreceding, -1)
    groups = staged(groups.withColumn("_first", F.coalesce(F.sum("_parts").over(before), F.lit(0)).cast("int")), "neg-groups")
    out = rows.join(groups.select(F.col("dim").alias("_d"), F.col("cluster").alias("_c"), "_parts", "_first"),
                    (F.col("dim") == F.col("_d")) & (F.col("cluster") == F.col("_c")))
    out = out.withColumn(no, F.col("_first") + F.pmod(F.xxhash64("rid"), F.col("_parts")).cast("int"))
    return out.drop("_d", "_c", "_parts", "_first"), groups


def _pairs(rows: DataFrame, other: DataFrame, no: str, own: bool) -> DataFrame:
    """Each row once per part of the other side: those of its own cluster, or those of the other clusters."""
    parts = F.sequence(F.lit(0), F.col("_parts") - 1)
    spans = other.select(F.col("dim").alias("_d"), F.col("cluster").alias("_c"), "_parts", "_first")
    if own:
        near = rows.join(spans, (F.col("dim") == F.col("_d")) & (F.col("cluster") == F.col("_c")))
        return near.withColumn(no, F.explode(F.transform(parts, lambda p: p + F.col("_first")))).drop(
            "_d", "_c", "_parts", "_first")
    lists = staged(spans.groupBy("_d").agg(F.array_sort(F.collect_list(F.struct("_c", "_first", "_parts"))).alias("_all")),
                   "neg-lists")
    far = rows.join(lists, F.col("dim") == F.col("_d")).withColumn("_span", F.explode("_all"))
    far = far.where(F.col("_span._c") != F.col("cluster"))
    return far.withColumn(no, F.explode(F.sequence(F.col("_span._first"), F.col("_span._first") + F.col("_span._parts") - 1))
                          ).drop("_d", "_all", "_span")


def search(anchors: DataFrame, slices: DataFrame, candidates: DataFrame, blocks: DataFrame, k: int,
           same_label: bool) -> DataFrame:
    """(arid, slot, score, id, rid, rank): the first ``k`` candidates of each anchor and score window."""
    def task(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return walk(left, right, k, same_label)

    def run(own: bool, these: DataFrame) -> DataFrame:
        keys = ["dim", "slice", "block"]
        left = _pairs(these, blocks, "block", own).select(*keys, "arid", "label", "q", "lo", "hi", "need")
        right = _pairs(candidates, slices, "slice", own).select(*keys, "rid", "id", "label", "q")
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(task, FOUND)
        return staged(found, "neg-own" if own else "neg-far")

    first = Window.partitionBy("arid", "slot").orderBy(F.desc("score"), "id", "rid")
    own = run(True, anchors)
    known = (own.withColumn("rank", F.row_number().over(first)).where(F.col("rank") == k)
             .groupBy(F.col("arid").alias("_a")).agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("_known")))
    raised = anchors.join(staged(known, "neg-known"), F.col("arid") == F.col("_a"), "left").withColumn(
        "need", F.transform("need", lambda n, i: F.greatest(n, F.coalesce(F.try_element_at("_known", i), n)))).drop("_a", "_known")
    both = own.unionByName(run(False, raised))
    return staged(both.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k), "neg-best")


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, vec_id: str = "vec_id", vector: str = "embedding",
                   label: str = "label", scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor and each of its first ``positives`` other rows of the same
    label, the first ``negatives`` rows of other labels whose score is
    ``low`` to ``high`` per cent of the positive's. Higher scores come first,
    ties by smaller id, then by place of the row.

    Rows without id, label or vector, with a null or non-finite component, or
    whose scores would not fit a long (length above 2^31 after scaling) take
    no part. Vectors of other lengths than the anchor's are never compared.
    Repeated rows are rows of their own: a second row with the anchor's id may
    be its positive. Zero vectors score 0. An anchor without positives, or a
    positive without a fitting negative, has no row. No rows give no rows;
    other columns are ignored.
    """
    rows = clustered(quantised(vectors, anchor, vec_id, vector, label, scale))
    candidates, blocks = dealt(rows.drop("anchor"), BLOCK, "block")
    members, slices = dealt(rows.where("anchor").drop("anchor"), SLICE, "slice")
    candidates, members = staged(candidates, "neg-candidates"), staged(
        members.withColumnsRenamed({"rid": "arid", "id": "aid"}), "neg-anchors")

    def longs(value: int) -> Column:
        return F.array(F.lit(value).cast("long"))

    wanted = members.withColumns({"lo": longs(NONE), "hi": longs(-NONE), "need": longs(NONE)})
    near = search(wanted, slices, candidates, blocks, positives, True)
    # window of each positive: ceil(low% of p) to floor(high% of p), in decimal as 100 * p may pass a long
    p = F.col("score").cast("decimal(20,0)")
    windows = near.select(F.col("arid").alias("_arid"), F.struct(
        "rank", "id", "score", F.ceil(p * low / 100).cast("long").alias("lo"),
        F.floor(p * high / 100).cast("long").alias("hi")).alias("w"))
    windows = staged(windows.groupBy("_arid").agg(F.array_sort(F.collect_list("w")).alias("w")), "neg-windows")
    held = members.join(windows, F.col("arid") == F.col("_arid"))
    padded = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda i: F.try_element_at("w", i))
    asked = held.withColumn("w", padded).select(
        "arid", "label", "q", "dim", "cluster", "slice",
        F.transform("w", lambda x: F.coalesce(x["lo"], F.lit(1).cast("long"))).alias("lo"),
        F.transform("w", lambda x: F.coalesce(x["hi"], F.lit(0).cast("long"))).alias("hi"),
        F.transform("w", lambda x: F.lit(NONE).cast("long")).alias("need"))
    far = search(staged(asked, "neg-asked"), slices, candidates, blocks, negatives, False)
    named = held.select("arid", F.col("aid").alias("anchor_id"), F.posexplode("w").alias("slot", "w"))
    return (far.select(F.col("arid").alias("_a"), F.col("slot").alias("_s"), F.col("rank"), F.col("id").alias("negative_id"),
                       F.col("score").alias("negative_score"))
            .join(named, (F.col("arid") == F.col("_a")) & (F.col("slot") == F.col("_s")))
            .select("anchor_id", F.col("w.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
                    F.col("w.score").alias("positive_score"), "negative_score"))
