"""Best-fit packing of token pieces by exact-complement hashing.

1. Documents become token ids, then pieces of at most ``capacity`` tokens, in
   one pass that writes the pieces (no texts, no ids) with the task that made
   them and their place among that task's pieces of equal length.
2. How many pieces each length has is a table of at most ``capacity`` rows.
   From it alone the packing plan is made. The longest remaining length's gap
   is looked up among single lengths, sums of pairs and sums of triples;
   a combination that fills the gap exactly is used as often as the counts
   allow, which uses up at least one length. What no combination fills goes
   best-fit, decreasing. Plan entries carry counts, so the plan does not grow
   with the corpus.
3. A piece's number among all pieces of its length (task-wise running counts)
   falls into one interval of the plan, which gives its sequence and offset.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import staged
from lodestar.llm.token_count import Splitter, in_blocks, probe_classes

CAPACITY = 2048
CLOSING_ID = 0
PIECES = ("doc_id {}, piece int, start long, length long, ids_crc32 long, part int, nth long")


SLOT_BITS = 20        # of the short pieces' table: 24 bytes a slot
MAX_IDS = 1 << 21     # ids that the table's slots hold together
SHORT = 15            # bytes of a short piece


class ShortPieces:
    """Ids of pieces of at most ``SHORT`` bytes, looked up for many pieces at once.

    Two words hold a piece's bytes and length, so equal words are equal
    pieces. A hash of them names the only slot that a piece may take: a newer
    piece replaces an older one, which changes no result, as a piece that is
    not found is encoded again.
    """

    def __init__(self) -> None:
        self.low, self.high = (np.zeros(1 << SLOT_BITS, np.uint64) for _ in range(2))  # no piece has length 0
        self.first, self.count = (np.zeros(1 << SLOT_BITS, np.int32) for _ in range(2))
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    @staticmethod
    def words(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(low, high, slot) of pieces of ``data``: bytes 0 to 7; bytes 8 to 14 and the length; the slot."""
        padded = data + bytes(16)
        at = np.ndarray(len(data) + 8, "<u8", padded, strides=(1,))
        bits = (8 * np.minimum(lengths, 8)).astype(np.uint64)
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        low = at[starts] & np.where(bits > 0, full >> (np.uint64(64) - np.maximum(bits, 8)), np.uint64(0))
        more = np.maximum(lengths, 8) - 8
        high = np.where(more > 0, at[starts + 8] & ((np.uint64(1) << (8 * np.minimum(more, 7)).astype(np.uint64)) - np.uint64(1)),
                        np.uint64(0)) | (np.minimum(lengths, SHORT).astype(np.uint64) << np.uint64(56))
        mixed = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return low, high, (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def add(self, low: np.ndarray, high: np.ndarray, slot: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        """Store pieces of different slots with ``count`` ids each, ``ids`` one after the other."""
        if self.used + len(ids) > MAX_IDS:
            self.high[:], self.used = 0, 0
        if len(ids) > MAX_IDS:
            return
        if self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids[:self.used], np.zeros(max(len(ids), self.used), np.uint32))
        self.ids[self.used:self.used + len(ids)] = ids
        self.low[slot], self.high[slot] = low, high
        self.first[slot], self.count[slot] = self.used + np.cumsum(count) - count, count
        self.used += len(ids)


def _runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each run of ``count`` places, one run after the other."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


class TokenIds:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, by the tokenizers library.

    The library encodes each distinct piece of text (as its own splitter cuts
    them) once per bounded generation of a table; the ids of a text are the
    ids of its pieces, one after the other. Short pieces are looked up in
    arrays first, a block of text at once.
    """

    def __init__(self, path: str, runs: tuple[np.ndarray, np.ndarray], max_pieces: int = 150_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.splitter = Splitter(runs)
        self.max_pieces = max_pieces
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.short = ShortPieces()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: np.uint32(i).tobytes() for i, t in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None

    def _encode(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of each piece; a special string, which no piece holds, keeps them apart in one text."""
        if not self.special:
            encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
            return zip(pieces, [np.asarray(e.ids, "<u4").tobytes() for e in encoded])
        between, mark = next(iter(self.special.items()))
        ids = self.tokenizer.encode_batch_fast([between.join(pieces)], add_special_tokens=False)[0].ids
        ids = np.asarray(ids, "<u4")
        cuts = np.flatnonzero(ids == np.frombuffer(mark, "<u4")[0])
        data = ids.tobytes()
        starts, ends = (4 * np.append(0, cuts + 1)).tolist(), (4 * np.append(cuts, len(ids))).tolist()
        return zip(pieces, [data[a:b] for a, b in zip(starts, ends)])

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        found = list(map(self.table.get, pieces))
        if None not in found:
            return found
        table, missing = self.table, []
        for p in {p for p, ids in zip(pieces, found) if ids is None}:
            known = self.older.get(p)
            if known is None:
                missing.append(p)
            else:
                table[p] = known
        for lo in range(0, len(missing), 20_000):
            table.update(self._encode(missing[lo:lo + 20_000]))
        found = list(map(table.get, pieces))
        if len(table) >= self.max_pieces:  # two generations: what is still in use moves on
            self.older, self.table = {p: v for p, v in table.items() if len(p) <= 64}, {}
        return found

    def _block_ids(self, block: str, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces ``block[a:b]`` one after the other, how many each piece has)."""
        data, starts, ends = block.encode("utf-8"), a, b
        if len(data) != len(block):  # places in bytes
            codes = np.frombuffer(block.encode("utf-32-le"), np.uint32)
            at = np.concatenate([[0], np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF).astype(np.int64) + (codes > 0xFFFF))])
            starts, ends = at[a], at[b]
        lengths, short = ends - starts, self.short
        low, high, slot = short.words(data, starts, lengths)
        known = (short.low[slot] == low) & (short.high[slot] == high) & (lengths <= SHORT)
        first, count = short.first[slot].astype(np.int64), short.count[slot].astype(np.int64)
        rest = np.flatnonzero(~known)
        if not len(rest):
            return short.ids[_runs(first, count)], count
        found = self._look_up([block[i:j] for i, j in zip(a[rest].tolist(), b[rest].tolist())])
        more = np.frombuffer(b"".join(found), "<u4")
        count[rest] = n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first[rest] = short.used + np.cumsum(n) - n
        ids = np.append(short.ids[:short.used], more)[_runs(first, count)]
        _, new = np.unique(np.where(lengths[rest] <= SHORT, slot[rest], -1), return_index=True)
        new = new[lengths[rest[new]] <= SHORT]  # one piece of each slot
        at = rest[new]
        short.add(low[at], high[at], slot[at], n[new], more[_runs(np.cumsum(n)[new] - n[new], n[new])])
        return ids, count

    def ids(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for block in in_blocks(texts):
            parts, owner, lead = [], [], []
            for i, text in enumerate(block):
                cut = self.cut.split(text or "") if self.cut else [text or ""]
                parts += cut[0::2]
                owner += [i] * len(cut[0::2])
                lead += [b"", *(self.special[s] for s in cut[1::2])]
            held = [[x] for x in lead]
            for run, a, b, part in self.splitter.bounds(parts):
                if not len(part):
                    continue
                ids, count = self._block_ids(run, a, b)
                data, edges = ids.astype("<u4").tobytes(), 4 * np.append(0, np.cumsum(count))
                bounds = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
                for p, i, j in zip(part[bounds[:-1]].tolist(), edges[bounds[:-1]].tolist(), edges[bounds[1:]].tolist()):
                    held[p].append(data[i:j])
            whole: list[list[bytes]] = [[] for _ in block]
            for i, pieces in zip(owner, held):
                whole[i] += pieces
            out += [b"".join(w) for w in whole]
        return out


@lru_cache(maxsize=2)
def _token_ids(path: str, runs_key: bytes, n: int) -> TokenIds:
    return TokenIds(path, (np.frombuffer(runs_key[:4 * n], np.int32), np.frombuffer(runs_key[4 * n:], np.uint8)))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents, staged: doc_id, piece, start, length, ids_crc32, part, nth.

    A document is its ids and a closing id; only one longer than ``capacity``
    is cut, into full pieces after a first one that takes the remainder.
    """
    first, cls = probe_classes(tokenizer_path)
    key, n = first.tobytes() + cls.tobytes(), len(first)
    closing = np.uint32(CLOSING_ID).tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _token_ids(tokenizer_path, key, n)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            at = 0
            for block in in_blocks(texts):
                for d, ids in zip(batch["doc_id"].iloc[at:at + len(block)], encoder.ids(block)):
                    ids += closing
                    total = len(ids) // 4
                    start, piece = 0, 0
                    while start < total:
                        length = (total - start) % capacity or capacity
                        rows.append((d, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]),
                                     part, seen[length]))
                        seen[length] += 1
                        start, piece = start + length, piece + 1
                at += len(block)
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    kind = docs.schema[doc_id].dataType.simpleString()
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # ids travel as text, so that null and large ids stay exact in pandas
    made = (thin.withColumn("doc_id", F.col("doc_id").cast("string"))
            .mapInPandas(cut, PIECES.format("string"))
            .withColumn("doc_id", F.col("doc_id").cast(kind)))
    return staged(made, "token-pieces")


class PackingPlan:
    """Which lengths share a sequence, from the counts of lengths alone."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.groups: list[tuple[int, list[int]]] = []  # (sequences, lengths in each)
        self._index_pairs()
        self._fill_exactly()
        self._best_fit()

    def _index_pairs(self) -> None:
        """Index of the sums that some pair of available lengths may have."""
        have = (self.left > 0).astype(np.float64)
        size = 1 << (2 * self.capacity + 1).bit_length()
        f = np.fft.rfft(have, size)
        self.pair_sums = np.fft.irfft(f * f, size)[:self.capacity + 1] > 0.5
        self.pairs_stale = False

    def _use(self, lengths: list[int]) -> bool:
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        n = min(int(self.left[x]) // k for x, k in need.items())
        if n:
            self.groups.append((n, lengths))
            for x, k in need.items():
                self.left[x] -= n * k
                self.pairs_stale |= self.left[x] == 0
        return n > 0

    def _pair(self, longest: list[int], gap: int) -> bool:
        """Use some pair that sums to ``gap`` beside ``longest``; the longest partner first."""
        b = np.arange(gap - 1, (gap + 1) // 2 - 1, -1)
        for x in b[(self.left[b] > 0) & (self.left[gap - b] > 0)].tolist():
            if self._use([*longest, x, gap - x]):
                return True
        return False

    def _fill_exactly(self) -> None:
        for a in range(self.capacity, 0, -1):
            gap = self.capacity - a
            while self.left[a]:
                if gap == 0:
                    self._use([a])
                elif gap >= 1 and self.left[gap] and self._use([a, gap]):
                    continue
                elif gap >= 2 and self._pair([a], gap):
                    continue
                elif gap >= 3 and self._triple(a, gap):
                    continue
                else:
                    break

    def _triple(self, a: int, gap: int) -> bool:
        if self.pairs_stale:
            self._index_pairs()
        b = np.arange(gap - 2, 0, -1)
        for x in b[(self.left[b] > 0) & self.pair_sums[gap - b]].tolist():
            if self._pair([a, x], gap - x):
                return True
        return False

    def _best_fit(self) -> None:
        """What is left, longest first, into the open sequences with the smallest gap that holds it."""
        open_: dict[int, list[tuple[int, list[int]]]] = {}
        for a in range(self.capacity, 0, -1):
            n = int(self.left[a])
            self.left[a] = 0
            while n:
                gap = next((g for g in sorted(open_) if g >= a), None)
                if gap is None:
                    per = self.capacity // a
                    k = min(per, n)
                    many = n // k
                    open_.setdefault(self.capacity - k * a, []).append((many, [a] * k))
                    n -= many * k
                    continue
                many, lengths = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
                k = min(gap // a, n)  # one sequence holds k more of them
                if many * k > n:
                    used = n // k
                    open_.setdefault(gap, []).append((many - used, lengths))
                    many = used
                open_.setdefault(gap - k * a, []).append((many, lengths + [a] * k))
                n -= many * k
        for held in open_.values():
            self.groups += held

    def intervals(self) -> np.ndarray:
        """Rows (length, first rank, copies in a sequence, first sequence, offset), sorted."""
        used = np.zeros(self.capacity + 1, np.int64)
        rows, sequence = [], 0
        for n, lengths in self.groups:
            offset = 0
            for x in dict.fromkeys(lengths):
                k = lengths.count(x)
                rows.append((x, int(used[x]), k, sequence, offset))
                used[x] += n * k
                offset += k * x
            sequence += n
        return np.array(sorted(rows), np.int64).reshape(-1, 5)


def placed(intervals: np.ndarray, length: Column, rank: Column) -> Column:
    """Struct (sequence_id, offset) of the piece with this rank among those of its length."""
    keys = (intervals[:, 0] << 48) + intervals[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        x, r = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        row = intervals[np.searchsorted(keys, (x << 48) + r, side="right") - 1]
        i = r - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + i // row[:, 2],
                             "offset": row[:, 4] + (i % row[:, 2]) * x})

    return place(length, rank)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to staged pieces (length, part, nth and any other columns)."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    intervals = PackingPlan(counts, capacity).intervals()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
             .select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return (pieces.join(bases, ["part", "length"])
            .withColumn("at", placed(intervals, F.col("length"), F.col("base") + F.col("nth")))
            .withColumn("sequence_id", F.col("at.sequence_id")).withColumn("offset", F.col("at.offset"))
            .drop("at", "base", "part", "nth"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all documents.

    A null text is empty: the closing id alone. Null and repeated doc_ids are
    kept, each row is a document of its own; other columns are ignored; no
    documents give no rows. Documents that are equal get equal ids but their
    own pieces.
    """
    out = pack(token_pieces(docs, tokenizer_path, capacity), capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
