"""SimHash near-duplicates through Golay-code fuzzy hashing.

The 64-bit fingerprints are cut into three segments of 22, 21 and 21 bits.
With at most two differing bits, one of the three segments is equal in both
fingerprints (pigeonhole) and any other differs in at most two bits.

A segment is read as a word of the binary Golay code [23, 12, 7], in which
every word is at most three bits from exactly one codeword. Its fuzzy keys are
the codewords nearest to the word itself and to each word one bit away: one
key if the word is within two bits of a codeword, else about six. Two words
that differ in at most two bits have a word in between that is one bit from
both, so they share a key.

Each distinct fingerprint is listed under (equal segment, fuzzy key of the
next segment), an equi-join on that key proposes pairs, and the bit distance
is verified in the join. Documents with equal fingerprints are joined once,
as one fingerprint. Components are found by joins (``connected_components``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import connected_components, staged, with_places

SEED = 42
SHINGLE = 3
MAX_BITS = 2
SEGMENTS = (22, 21, 21)
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SLICE = 1 << 16


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash: bit set in over half of the shingles' XXH64 hashes."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only; the six ASCII blanks
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    runs = zip(*(islice(words, i, None) for i in range(shingle))) if len(words) >= shingle else iter([words])
    while True:
        hashes = [digest(b" ".join(r), SEED) for r in islice(runs, SLICE)]
        if not hashes:
            break
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def simhash(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint of each text as a signed long; null and wordless texts have 0."""
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [fingerprint_of(t if isinstance(t, str) else None, shingle) for t in batch]
            yield pd.Series(np.array(found, np.uint64).view(np.int64))

    return prints(text)


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(remainders of 23-bit words by their low 12 and high 11 bits, error pattern of each remainder)."""
    def remainder(words: np.ndarray) -> np.ndarray:
        words = words.copy()
        for bit in range(22, 10, -1):
            words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
        return words

    single = 1 << np.arange(23)
    pairs = (single[:, None] | single[None, :]).ravel()
    triples = (pairs[:, None] | single[None, :]).ravel()
    patterns = np.unique(np.concatenate([[0], single, pairs, triples]))
    errors = np.zeros(2048, np.int64)
    errors[remainder(patterns)] = patterns  # perfect code: one pattern of up to 3 errors for each
    parts = np.concatenate([remainder(np.arange(4096)), remainder(np.arange(2048) << 12)])
    return parts, errors


def nearest_codeword(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword within three bits of each 23-bit word."""
    parts, errors = golay_tables()
    rest = parts[words & 4095] ^ parts[4096 + (words >> 12)]
    return (words ^ errors[rest]) >> 11


def fuzzy_keys(words: np.ndarray, bits: int) -> list[np.ndarray]:
    """Distinct codeword indices of each word and its one-bit neighbours (within ``bits`` bits)."""
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    near = np.sort(nearest_codeword(words[:, None] ^ flips[None, :]), axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    return [row[keep] for row, keep in zip(near, new)]


def search_keys(fingerprints: np.ndarray) -> list[np.ndarray]:
    """Keys (segment number, segment, fuzzy key of the next segment) of each fingerprint."""
    values, at, segments = fingerprints.view(np.uint64), 0, []
    for width in SEGMENTS:
        segments.append((values >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64))
        at += width
    keys: list[list[np.ndarray]] = [[] for _ in values]
    for i, segment in enumerate(segments):
        j = (i + 1) % len(segments)
        for row, (s, fuzzy) in enumerate(zip(segment, fuzzy_keys(segments[j], SEGMENTS[j]))):
            keys[row].append((i << 40) | (s << 12) | fuzzy)
    return [np.concatenate(k) for k in keys]


def links(prints: DataFrame, column: str = "fp", max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in 1 to ``max_bits`` bits (at most 2)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("three segments and one-bit neighbours find up to two differing bits")

    @F.pandas_udf("array<long>")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(search_keys(batch.to_numpy(np.int64)))

    listed = staged(prints.select(F.col(column).alias("fp"), F.explode(keys(F.col(column))).alias("key")),
                    "simhash-keys")
    a, b = listed.select(F.col("fp").alias("a"), "key"), listed.select(F.col("fp").alias("b"), F.col("key").alias("_k"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return a.join(b, (F.col("key") == F.col("_k")) & (F.col("a") < F.col("b")) & close).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; ``fp`` is the signed long.

    component_id is the smallest doc_id reachable over fingerprints at most
    ``max_bits`` apart. Null and wordless texts have fingerprint 0 and link as
    any other. Repeated rows get the same component; a row without doc_id
    links like any other and names no component (null if no member has an
    id). No rows give no rows; other columns are ignored.
    """
    rows = staged(docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text), shingle).alias("fp")),
                  "simhash-prints")
    return rows.join(components(rows, max_bits), F.col("fp") == F.col("_fp")).drop("_fp", "_root")


def components(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(_fp, _root, component_id) for each distinct fingerprint of staged rows (doc_id, fp).

    ``_root`` is the smallest fingerprint of the component and names it; where
    doc_ids repeat or lack, unlike components can share a component_id.
    """
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected_components(links(prints, "fp", max_bits), "a", "b")
    named = prints.join(roots, F.col("fp") == F.col("id"), "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component", "fp").alias("root"), "least")
    named = staged(named, "simhash-roots")
    ids = staged(named.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component_id")), "simhash-ids")
    return staged(named.join(ids, F.col("root") == F.col("_root")).select("_fp", "_root", "component_id"), "simhash-named")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: the smallest doc_id's (of repeated rows the first read).

    Components are told apart by their fingerprints: unlike rows that share a
    doc_id stay, and of near rows that all lack one a single row stays.

    Rows are named by their file and their place in it; a DataFrame that is
    not a plain file table is written as one first. So only thin rows are
    staged, and the texts cross one exchange, at every size, when the kept
    rows are picked.
    """
    placed, file, row = with_places(docs)
    thin = staged(placed.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text), shingle).alias("fp"),
                                F.col(file).alias("file"), F.col(row).alias("row")), "simhash-thin")
    named = components(thin.select("doc_id", "fp"), max_bits)
    # the members of one fingerprint meet in a partial aggregate, the fingerprints of a component in another
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "file", "row"))
    best = thin.groupBy("fp").agg(first.alias("first")).join(named, F.col("fp") == F.col("_fp"))
    keep = best.groupBy("_root").agg(F.min("first").alias("first"))
    keep = staged(keep.select(F.col("first.file").alias("_keep_file"), F.col("first.row").alias("_keep_row")), "simhash-keep")
    return placed.join(keep.hint("merge"), (F.col(file) == F.col("_keep_file")) & (F.col(row) == F.col("_keep_row"))
                       ).select(*docs.columns)
