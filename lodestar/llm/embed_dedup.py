"""Near-duplicate vectors by random-hyperplane sign hashing.

Equal vectors are first collapsed to one representative with a count. Each
representative is hashed in several tables: the signs against ``bits`` random
hyperplanes form its bucket. Two vectors at the cosine threshold c agree on a
sign with probability p = 1 - acos(c) / pi, so a table finds them with p^bits;
the number of tables makes the chance that all miss at most ``MISS``.

Within a bucket cosines are computed exactly in double precision. A large
bucket is dealt into blocks and every pair of blocks is a task of its own, so
no bucket has to fit into one. A pair that meets in several tables counts in
the first only. A task returns one row per vector (its number of links) and
its link to the smallest vector it is connected to there, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import connected_components, staged

THRESHOLD = 0.9
MISS = 1e-7
BLOCK = 4096   # vectors in a block
STRIP = 256    # rows of a block that are multiplied at once


def hash_shape(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for n vectors: buckets of about a thousand, and tables by the recall wanted."""
    bits = max(4, math.ceil(math.log2(max(n, 2) / 1024)))
    agree = 1 - math.acos(threshold) / math.pi
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - agree ** bits)))


def unit_rows(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of unit vectors in double, Euclidean safe from overflow; index) of equally long rows."""
    m = np.array(vectors.to_list(), np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _usable(v) -> bool:
    if v is None or len(v) == 0:
        return False
    try:
        a = np.asarray(v, np.float64)
    except (TypeError, ValueError):
        return False
    return bool(np.isfinite(a).all() and np.any(a))


def _signatures(unit: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    planes = np.random.default_rng([seed, unit.shape[1]]).standard_normal((unit.shape[1], bits * tables))
    signs = (unit @ planes > 0).reshape(len(unit), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def links_in_blocks(part: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of one pair of blocks of a bucket, found in table ``tbl`` and in no earlier one.

    Columns in: node, copies, v, sigs, tbl, block, b1, b2. Out: node, linked
    (copies linked), low (smallest node it is connected to here).
    """
    one, two = int(part["b1"].iloc[0]), int(part["b2"].iloc[0])
    part = part.sort_values("node", kind="stable")
    left, right = part[part["block"] == one], part[part["block"] == two]
    if not len(left) or not len(right):
        return pd.DataFrame({"node": [], "linked": [], "low": []}, dtype=np.int64)
    table = int(part["tbl"].iloc[0])
    a, b = unit_rows(left["v"]), unit_rows(right["v"])
    sa, sb = (np.array(x["sigs"].to_list(), np.int64).reshape(len(x), -1)[:, :table] for x in (left, right))
    ca, cb = left["copies"].to_numpy(np.int64), right["copies"].to_numpy(np.int64)
    na, nb = left["node"].to_numpy(np.int64), right["node"].to_numpy(np.int64)
    nodes = np.union1d(na, nb)
    at_a, at_b = np.searchsorted(nodes, na), np.searchsorted(nodes, nb)
    linked = np.zeros(len(nodes), np.int64)
    low = np.arange(len(nodes))
    for lo in range(0, len(a), STRIP):
        close = a[lo:lo + STRIP] @ b.T >= threshold
        if one == two:
            close &= na[lo:lo + STRIP, None] < nb[None, :]
        i, j = np.nonzero(close)
        for k in range(0, len(i), 100_000):
            x, y = i[k:k + 100_000] + lo, j[k:k + 100_000]
            fresh = ~(sa[x] == sb[y]).any(axis=1) if table else np.ones(len(x), bool)
            x, y = x[fresh], y[fresh]
            np.add.at(linked, at_a[x], cb[y])
            np.add.at(linked, at_b[y], ca[x])
            low = _join(low, at_a[x], at_b[y])
    seen = (linked > 0) | (low != np.arange(len(nodes)))
    return pd.DataFrame({"node": nodes[seen], "linked": linked[seen], "low": nodes[low[seen]]})


def _join(low: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest connected index after adding the links x - y to those that ``low`` stands for."""
    if not len(x):
        return low
    low = low.copy()
    while True:
        least = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, low[x], least)
        np.minimum.at(new, low[y], least)
        new = new[new]
        if np.array_equal(new, low):
            return low
        low = new


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, seed: int = 7,
                           vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, nor do vectors of different lengths; they are their own
    component. Equal vectors link with each other. Repeated rows are vectors
    of their own. Rows without vec_id link but name no component. No rows give
    no rows; other columns are ignored.
    """
    v = F.col("v")
    usable = (v.isNotNull() & (F.size("v") > 0)
              & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("v", lambda x: x != 0))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v"))
    rows = staged(rows.withColumn("h1", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("v")))
                  .withColumn("h2", F.when(F.col("h1").isNotNull(), F.xxhash64("v", F.lit("second")))), "vec-rows")
    reps = (rows.where("h1 is not null").groupBy("h1", "h2")
            .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v")))
    reps = staged(reps.withColumn("node", F.monotonically_increasing_id()), "vec-distinct")
    bits, tables = hash_shape(reps.count(), threshold)

    @F.pandas_udf("array<long>")
    def signatures(vs: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(vs), dtype=object)
        lengths = vs.map(len)
        for dim in lengths.unique():  # vectors of another length have planes of their own
            these = (lengths == dim).to_numpy()
            sigs = _signatures(unit_rows(vs[these]), bits, tables, seed)
            out.iloc[np.flatnonzero(these)] = pd.Series(list(sigs), dtype=object).to_numpy()
        return out

    hashed = staged(reps.select("node", "copies", "v", F.size("v").alias("dim"), signatures("v").alias("sigs")),
                    "vec-hashed")
    places = hashed.select("node", "dim", F.posexplode("sigs").alias("tbl", "sig"))
    sizes = (places.groupBy("dim", "tbl", "sig").agg(F.count("*").alias("n")).where("n > 1")
             .select(F.col("dim").alias("_d"), F.col("tbl").alias("_t"), F.col("sig").alias("_s"),
                     F.ceil(F.col("n") / F.lit(float(BLOCK))).cast("int").alias("blocks")))
    dealt = (hashed.select("*", F.posexplode("sigs").alias("tbl", "sig"))
             .join(staged(sizes, "vec-buckets"),
                   (F.col("dim") == F.col("_d")) & (F.col("tbl") == F.col("_t")) & (F.col("sig") == F.col("_s")))
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("b1", F.least("block", "other")).withColumn("b2", F.greatest("block", "other"))
             .select("node", "copies", "v", "sigs", "dim", "tbl", "sig", "block", "b1", "b2"))

    def task(part: pd.DataFrame) -> pd.DataFrame:
        return links_in_blocks(part, threshold)

    found = staged(dealt.groupBy("dim", "tbl", "sig", "b1", "b2")
                   .applyInPandas(task, "node long, linked long, low long"), "vec-links")
    linked = staged(found.groupBy(F.col("node").alias("_n")).agg(F.sum("linked").alias("linked")), "vec-linked")
    roots = connected_components(found.where("node != low"), "node", "low")
    named = staged(reps.select("node", "h1", "h2", "least", "copies")
                   .join(linked, F.col("node") == F.col("_n"), "left")
                   .join(roots, F.col("node") == F.col("id"), "left")
                   .select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "least",
                           (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"),
                           F.coalesce("component", "node").alias("root")), "vec-named")
    ids = staged(named.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component")), "vec-components")
    named = staged(named.join(ids, F.col("root") == F.col("_root")).select("_h1", "_h2", "links", "component"),
                   "vec-result")
    component = F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return (rows.join(named, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")))
