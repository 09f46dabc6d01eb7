"""Sharding by balanced label propagation.

Documents with equal texts are linked. Only a group larger than a shard, which
no placement can keep whole, is placed beforehand: it is divided into runs
that fill a shard each and one remainder.

The rows of all other groups start along the shards' remaining room by a hash
of the row, which knows nothing of the texts. Then, round by round, joins tell
each document in which shard most of its neighbours (by bytes) are, documents
ask to move there, and quotas for each pair of shards decide how many may: a
shard never gets more than its capacity, and one that too many ask for is
closed for a while, so that divided groups gather elsewhere. Rounds end when
nobody asks, or when a round has gathered nothing more.

Documents without a neighbour cut no edge wherever they are, so they are
placed last and fill the shards to equal bytes: the few that are large
against a shard go one by one to the emptiest, the others along the shards'
remaining room.

The driver holds the matrix of wishes between shards, the shards' loads, fewer
groups than shards and at most ``FINE`` large documents per shard; all else
are joins and windows over narrow rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import running_totals, staged

SHARDS = 24
FINE = 400  # a single document is large if it exceeds 1/FINE of a shard


def document_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _buckets(df: DataFrame, rows: int, by: str = "rid") -> Column:
    """A hash of the row (or of ``by``) in [0, buckets), with about 100 rows each (at most 65,536 buckets)."""
    return F.pmod(F.xxhash64(by), F.lit(max(1, min(65_536, rows // 100)))).cast("int")


def quotas(wishes: np.ndarray, loads: np.ndarray, capacity: float) -> np.ndarray:
    """Bytes that may move from shard i to j: the wishes, scaled down where a shard would overflow."""
    x = wishes.astype(float)
    for _ in range(200):
        after = loads + x.sum(0) - x.sum(1)
        over = np.flatnonzero(after > np.maximum(capacity, loads) + 1)
        over = over[x[:, over].sum(0) > 0]
        if not len(over):
            break
        for j in over:
            inflow = x[:, j].sum()
            x[:, j] *= max(0.0, inflow - (after[j] - max(capacity, loads[j]))) / inflow
    else:
        x[:] = 0
    return np.floor(x)


def _linked_rows(rows: DataFrame, total: int, shards: int) -> tuple[DataFrame, DataFrame, DataFrame, list]:
    """(rows of groups above a shard, rows of the other groups, single rows, (key, rows, bytes) of each group above a shard)."""
    groups = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).where("n > 1")
    groups = staged(groups.withColumnsRenamed({"key": "_key", "n": "_n", "bytes": "_bytes"}), "shard-groups")
    both = staged(rows.join(groups, F.col("key") == F.col("_key"), "left").drop("_key"), "shard-linked")
    large = F.col("_bytes") > max(1, total // shards)
    # fewer groups than shards
    found = [tuple(r) for r in groups.where(large).select("_key", "_n", "_bytes").collect()]
    parts = [both.where(c).drop("_n", "_bytes") for c in (large, ~large, F.col("_n").isNull())]
    return *parts, found


def place_groups(groups: list[tuple[str, int, int]], shards: int,
                 capacity: float) -> tuple[list[tuple[str, int, int, int]], np.ndarray]:
    """((key, first row, row after the last, shard) of each part of each group, loads of the shards).

    groups: (key, rows, bytes), all rows of a group of one size.
    """
    runs = []
    for key, n, size in groups:
        each = size // n
        full = max(1, int(capacity // each))  # rows that fill a shard
        runs += [(each * (min(n, at + full) - at), key, each, at, min(n, at + full)) for at in range(0, n, full)]
    loads, parts = np.zeros(shards), []
    for _, key, each, at, end in sorted(runs, key=lambda r: (-r[0], r[1], r[3])):
        while at < end:
            room = np.floor((capacity - loads) / each)
            holds = room >= end - at
            s = int(np.where(holds, room, np.inf).argmin() if holds.any() else room.argmax())
            to = min(end, at + max(1, int(room[s])))
            parts.append((key, at, to, s))
            loads[s] += each * (to - at)
            at = to
    return parts, loads


def _place_large(large: DataFrame, rows: int, parts: list[tuple[str, int, int, int]]) -> DataFrame:
    """Rows of large groups with the shard of their part."""
    numbered = running_totals(large.withColumn("bucket", _buckets(large, rows)), ["key"], "bucket", ["rid"],
                              F.lit(1), "at")
    placed = large.sparkSession.createDataFrame(parts, "_key string, _from long, _to long, shard int")
    mine = (F.col("key") == F.col("_key")) & (F.col("at") >= F.col("_from")) & (F.col("at") < F.col("_to"))
    return numbered.join(F.broadcast(placed), mine).select(*large.columns, "shard")


def propagate(state: DataFrame, held: np.ndarray, capacity: float) -> DataFrame:
    """Linked rows (rid, key, size, shard), equal keys gathered as far as room allows.

    held: bytes that the shards hold besides these rows.
    """
    n, shards = state.count(), len(held)
    closed, kept, settled = np.zeros(shards, bool), -1, state
    while True:
        cells = staged(state.groupBy("key", "shard").agg(F.sum("size").alias("w")), "shard-cells")
        square = F.col("w").cast("decimal(19,0)") * F.col("w").cast("decimal(19,0)")
        now = cells.agg(F.sum(square)).first()[0] or 0
        if now <= kept:
            return settled  # no wish could be granted, or the round has gathered nothing more
        kept, settled = now, state
        # where most of the group is; closed shards come after all others
        charge = F.element_at(F.array(*[F.lit(1e-6 if c else 1.0) for c in closed]), F.col("shard") + 1)
        best = cells.groupBy("key").agg(
            F.max(F.struct((F.col("w") * charge).alias("w"), F.xxhash64("key", "shard"), "shard"))["shard"].alias("best"))
        best = staged(best.withColumnRenamed("key", "_key"), "shard-best")
        wished = staged(state.join(best, F.col("key") == F.col("_key")).drop("_key"), "shard-wished")
        wishes, loads = np.zeros((shards, shards)), held.copy()
        for r in wished.groupBy("shard", "best").agg(F.sum("size").alias("w")).collect():
            loads[r["shard"]] += r["w"]
            if r["shard"] != r["best"]:
                wishes[r["shard"], r["best"]] = r["w"]
        if not wishes.sum():
            return state
        # a shard that more ask for than it holds is closed until it has room again: divided groups
        # gather where else they are, groups that are whole have no other place to wish for
        asked_for = loads + wishes.sum(0) - wishes.sum(1)
        closed = (asked_for > capacity) | (closed & (loads > 0.9 * capacity))
        allowed = quotas(wishes, loads, capacity)
        flat = F.array(*[F.lit(int(q)) for q in allowed.ravel()])
        movers = wished.where("shard != best").withColumn("bucket", _buckets(wished, n, "key"))
        movers = running_totals(movers, ["shard", "best"], "bucket", ["key", "rid"], "size", "before")
        goes = F.col("before") + F.col("size") <= F.element_at(flat, F.col("shard") * shards + F.col("best") + 1)
        movers = movers.withColumn("shard", F.when(goes, F.col("best")).otherwise(F.col("shard")))
        state = staged(wished.where("shard = best").drop("best")
                       .unionByName(movers.select(*state.columns)), "shard-state")


def _pour(rows: DataFrame, held: np.ndarray, count: int, order: list[str]) -> DataFrame:
    """Rows with a shard each, along the shards' room up to a common level, those of equal ``order[0]`` together."""
    shards = len(held)
    rest = float(rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    low = np.sort(held)
    levels = (rest + np.cumsum(low)) / np.arange(1, shards + 1)
    level = next(v for i, v in enumerate(levels) if i == shards - 1 or v <= low[i + 1])
    edges = np.cumsum(np.maximum(0, level - held))
    run = rows.withColumn("bucket", _buckets(rows, count, order[0])).withColumn("_all", F.lit(0))
    run = running_totals(run, ["_all"], "bucket", order, "size", "before")
    middle = F.col("before") + F.col("size") / F.lit(2.0)
    past = [(middle >= F.lit(float(e))).cast("int") for e in edges[:-1]]
    return run.withColumn("shard", sum(past, F.lit(0))).select(*rows.columns, "shard")


def _fill(single: DataFrame, loads: np.ndarray, total: int, rows: int, shards: int) -> DataFrame:
    """Singles with a shard each, so that all shards have equal bytes."""
    large = max(1, total // (shards * FINE))
    heap = [(int(b), s) for s, b in enumerate(loads)]
    heapq.heapify(heap)
    chosen = []
    # fewer than shards * FINE documents can exceed total / (shards * FINE)
    for r in sorted(single.where(F.col("size") > large).select("rid", "size").collect(),
                    key=lambda r: (-r["size"], r["rid"])):
        b, s = heapq.heappop(heap)
        chosen.append((r["rid"], s))
        heapq.heappush(heap, (b + r["size"], s))
    spark = single.sparkSession
    placed = spark.createDataFrame(chosen, "_rid long, shard int")
    by_hand = single.where(F.col("size") > large).join(placed, F.col("rid") == F.col("_rid")).drop("_rid")
    held = np.zeros(shards)
    for b, s in heap:
        held[s] = b
    small = _pour(single.where(F.col("size") <= large), held, rows, ["rid"])
    return by_hand.unionByName(small.select(*by_hand.columns))


def balanced_shards(docs: DataFrame, shards: int = SHARDS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row.

    Shards are near equal in bytes, and equal texts are in one shard where a
    shard can hold them; more of them fill whole shards and part of one other. ``slot`` numbers a shard's rows from 0 without gaps.
    A null text has size 8 and is linked with other null texts only; empty
    texts likewise; null and repeated doc_ids are rows of their own; no rows
    give no rows; other columns are ignored.
    """
    t = F.col(text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), document_size(t).alias("size"),
                       F.crc32(F.coalesce(t, F.lit(""))).alias("text_crc32"),
                       F.coalesce(F.md5(t), F.lit("")).alias("key"))
    rows = staged(rows.withColumn("rid", F.monotonically_increasing_id()), "shard-rows")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    large, small, single, groups = _linked_rows(rows, total, shards)
    parts, loads = place_groups(groups, shards, total / shards)
    small = staged(_pour(small, loads, n, ["rid"]), "shard-state")  # by hash: this start does not know the keys
    small = propagate(small, loads, total / shards)
    state = _place_large(large, n, parts).unionByName(small)
    for r in small.groupBy("shard").agg(F.sum("size").alias("w")).collect():
        loads[r["shard"]] += r["w"]
    columns = ["rid", "doc_id", "size", "text_crc32", "shard"]
    out = state.select(*columns).unionByName(_fill(single, loads, total, n, shards).select(*columns))
    out = staged(out.withColumn("bucket", _buckets(out, n)), "shard-placed")
    return (running_totals(out, ["shard"], "bucket", ["rid"], F.lit(1), "slot")
            .select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")))
