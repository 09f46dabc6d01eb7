import random
import re

import numpy as np
import pytest
import xxhash

from lodestar.llm import embed_dedup, simhash
from lodestar.llm.common import connected_components


def brute_components(ids, linked):
    """Smallest id reachable; ``linked`` is a boolean matrix."""
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            least = min([label[i], *(label[j] for j in np.flatnonzero(linked[i]))])
            changed |= least != label[i]
            label[i] = least
    return label


def plain_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def close_matrix(prints):
    return np.array([[bin(a ^ b).count("1") <= 2 for b in prints] for a in prints])


def test_near_duplicates_equal_brute_force(documents):
    rows = documents.select("doc_id", "text").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    want = brute_components([r.doc_id for r in rows], close_matrix(prints))
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(documents).collect()}
    assert [got[r.doc_id] for r in rows] == list(zip(prints, want))


def test_components_of_awkward_rows(awkward, nothing):
    out = simhash.near_duplicates(awkward).collect()
    assert len(out) == awkward.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert by[1] == by[2] == by[3] == {(0, 1)}
    assert by[7] == by[9] and len(by[7]) == 1 and by[7].pop()[1] == 7
    assert by[None].pop()[1] is None
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 7, 8, 10] and ids.count(None) == 1
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_one_row_of_each_component_with_shared_or_no_ids(spark):
    def near(n):  # texts with two different fingerprints at most two bits apart
        base = [f"w{n}x{i}" for i in range(400)]
        for i in range(400):
            other = base[:i] + ["changed"] + base[i + 1:]
            a, b = " ".join(base), " ".join(other)
            if 1 <= bin(plain_fingerprint(a) ^ plain_fingerprint(b)).count("1") <= 2:
                return [a, b]

    pairs = [near(n) for n in range(4)]
    # one doc_id on unlike texts; a component with and one without an id
    rows = [(5, f"text {i} of its own, unlike number {i * i}") for i in range(20)]
    rows += [(5, t) for t in pairs[0]] + [(5, t) for t in pairs[1]] + [(9, pairs[2][0]), (None, pairs[2][1])]
    rows += [(None, t) for t in pairs[3]]
    prints = [plain_fingerprint(t) for _, t in rows]
    label = brute_components(prints, close_matrix(prints))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(df).collect()]
    of = dict(zip((t for _, t in rows), label))
    assert sorted(of[t] for _, t in kept) == sorted(set(label))
    assert sorted(i for i, _ in kept if i) == [5] * 22 + [9] and len(kept) == 24


def test_words_within_two_bits_share_a_fuzzy_key():
    rng = random.Random(2)
    for bits in (21, 22, 23):
        words = [rng.getrandbits(bits) for _ in range(300)]
        others = [w ^ sum(1 << b for b in rng.sample(range(bits), rng.randint(0, 2))) for w in words]
        a, b = (simhash.fuzzy_keys(np.array(x), bits) for x in (words, others))
        assert all(set(x) & set(y) for x, y in zip(a, b))
        assert max(map(len, a)) <= 6 + 1


def test_golay_code_is_perfect():
    words = np.arange(1 << 12)
    codewords = np.unique(words << 11 | simhash.golay_tables()[0][4096 + (words << 11 >> 12)]
                          ^ simhash.golay_tables()[0][(words << 11) & 4095])
    assert len(codewords) == 4096
    gaps = [bin(int(c)).count("1") for c in codewords if c]
    assert min(gaps) == 7


def test_planted_fingerprints_are_linked(spark):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(60)]
    prints = set(centres)
    for c in centres:
        at = c
        for _ in range(12):  # chains of steps of one or two bits
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 2)))
            prints.add(at)
    prints = sorted(prints)
    df = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long")
    got = {(r.a % 2**64, r.b % 2**64) for r in simhash.links(df).collect()}
    near = close_matrix(prints)
    want = {frozenset((prints[i], prints[j])) for i, j in zip(*np.nonzero(near)) if i < j}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)
    with pytest.raises(ValueError):
        simhash.links(df, max_bits=3)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [(5, 5), (101, 100)]
    random.Random(1).shuffle(edges)
    out = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200 + i: 200 for i in range(9)}
    assert {r.id: r.component for r in out} == want and len(out) == len(want)


def plain_vectors(rows, threshold=0.9):
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    linked = np.zeros((len(rows), len(rows)), bool)
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows):
            if i != j and usable[i] and usable[j] and len(a) == len(b):
                x, y = np.array(a, float) / np.abs(a).max(), np.array(b, float) / np.abs(b).max()
                linked[i, j] = x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold
    return linked


def planted_vectors(n=30, copies=8, dim=16):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(n):
        centre = rng.standard_normal(dim)
        for _ in range(copies):
            rows.append((len(rows), (centre + rng.standard_normal(dim) * rng.choice([0, .1, .3, .5])).tolist()))
    return rows


def test_vector_links_equal_brute_force(spark, monkeypatch):
    rows = planted_vectors()
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [1.0, None] * 8),
             (1005, [float("inf")] + [1.0] * 15), (1006, [1e300] * 16), (1007, [1e-300] * 16), (1008, [1.0, 1.0]),
             (1009, [2.0, 2.0])]
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)  # several blocks in a bucket
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as node", "2 as links")
    out = {r.vec_id: r for r in embed_dedup.near_duplicate_vectors(df).collect()}
    linked = plain_vectors(rows)
    ids = [i for i, _ in rows]
    component = brute_components(ids, linked)
    assert [out[i].n_links for i in ids] == linked.sum(1).tolist()
    assert [out[i].component_id for i in ids] == component
    assert [out[i].kept for i in ids] == [i == c for i, c in zip(ids, component)]


def test_vectors_repeated_unnamed_or_none(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (2, [0.0, 1.0]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = [tuple(r) for r in embed_dedup.near_duplicate_vectors(df).collect()]
    assert sorted(out, key=str) == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (2, 0, 2, True),
                                           (None, 0, None, False)], key=str)
    assert embed_dedup.near_duplicate_vectors(df.where("false")).count() == 0
