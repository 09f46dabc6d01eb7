import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from lodestar.llm.common import running_totals, word_count
from lodestar.llm.mixing import curriculum, mixture_targets, training_order
from lodestar.llm.sharding import balanced_shards, place_groups, propagate, quotas


def n_words(text):
    return len([w for w in re.split("[\x20\x09-\x0d]+", text or "") if w])


def plain_targets(sizes):
    """Water filling, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def check_mix(rows, docs):
    sizes = defaultdict(int)
    for d in docs:
        sizes[d.source] += n_words(d.text)
    want = plain_targets(sizes)
    taken, by_text = Counter(), Counter()
    for r in rows:
        assert r["size"] == n_words(r.doc.text) and r.source_size == sizes[r.doc.source]
        assert abs(r.target - want[r.doc.source]) < 1e-6 * max(1, r.target)
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 3 == 3
        assert len(r.positions) == r.copies and all(0 <= p <= 1 for p in r.positions)
        taken[r.doc.source] += r.taken
    for s, t in want.items():
        largest = max(n_words(d.text) for d in docs if d.source == s)
        assert abs(taken[s] - t) <= largest / 2 + 1


def test_mix_meets_its_targets(documents):
    mixed = curriculum(documents, word_count(F.col("text")))
    rows = mixed.collect()
    assert len(rows) == documents.count()
    check_mix(rows, documents.collect())
    again = curriculum(documents.repartition(5), word_count(F.col("text")))
    assert {r.doc.doc_id: r.positions for r in again.collect()} == {r.doc.doc_id: r.positions for r in rows}


def test_training_order_is_sorted_and_whole(documents):
    mixed = curriculum(documents, word_count(F.col("text")))
    ordered = training_order(mixed)
    assert ordered.columns == documents.columns
    want = Counter({r.doc.doc_id: r.copies for r in mixed.collect()})
    got = [r.doc_id for r in ordered.collect()]
    assert Counter(got) == +want
    first = {r.doc.doc_id: min(r.positions) for r in mixed.collect() if r.copies}
    seen = list(dict.fromkeys(got))
    assert [first[d] for d in seen] == sorted(first[d] for d in seen)


def test_mix_of_awkward_rows(awkward, nothing):
    rows = curriculum(awkward, word_count(F.col("text"))).collect()
    assert len(rows) == awkward.count()
    check_mix(rows, awkward.collect())
    assert training_order(curriculum(awkward, word_count(F.col("text")))).columns == awkward.columns
    assert curriculum(nothing, word_count(F.col("text"))).count() == 0


def test_targets_of_uneven_sources(spark):
    for sizes in ({"a": 1, "b": 1000, None: 5}, {"a": 0}, {"z": 7, "y": 0, "x": 900, "é": 3, "w": 1, "B": 50}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in mixture_targets(df).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
        assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6


def test_running_totals_equal_a_plain_sum(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i * 37 % 101, i, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, b int, i long, v long")
    sums = Counter()
    want = {}
    for g, b, i, v in sorted(rows):
        want[i] = sums[g]
        sums[g] += v
    assert {r.i: r.t for r in running_totals(df, ["g"], "b", ["i"], "v", "t").collect()} == want


def check_shards(rows, docs, shards, slack):
    assert Counter((r.doc_id, r.text_crc32) for r in rows) == Counter(
        (d.doc_id, zlib.crc32((d.text or "").encode())) for d in docs)
    load, slots = Counter(), defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    total = sum(load.values())
    assert total == sum(len((d.text or "").encode()) + 8 for d in docs)
    assert max(load.values()) - min(load[s] for s in range(shards)) <= slack


def test_shards_are_even_and_keep_copies_together(spark, documents):
    # groups of up to 9 copies, one group with a third of the rows
    base = [r for r in documents.select("doc_id", "text").collect() if r.text and len(r.text) < 3000]
    rows, n = [], 0
    for i, r in enumerate(base):
        for _ in range(1 + i % 9 if i % 5 == 0 else 1):
            rows.append((n, r.text))
            n += 1
    rows += [(n + i, "a short text that very many documents share") for i in range(n // 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = balanced_shards(df, shards=6).collect()
    docs = df.collect()
    check_shards(out, docs, 6, 3000)
    text = dict(rows)
    where = defaultdict(Counter)
    for r in out:
        where[text[r.doc_id]][r.shard] += 1
    groups = {t: c for t, c in where.items() if sum(c.values()) > 1}
    split = [t for t, c in groups.items() if len(c) > 1]
    assert len(split) <= 0.1 * len(groups)
    # random placement would keep about a sixth of the links
    kept = sum(k * k for c in groups.values() for k in c.values())
    assert kept > 0.8 * sum(sum(c.values()) ** 2 for c in groups.values())


def test_large_groups_fill_shards(spark):
    # 24 shards: a group with a third of the bytes (8 shards), one of 0.6 shard, small groups, single texts
    rows = ["a text that a third of all the bytes is made of"] * 8000
    shard = sum(len(t) + 8 for t in rows) // 8
    rows += ["more than half of a shard"] * (shard * 6 // 10 // 33)
    rows += [f"small group {i} of equal texts" for i in range(600) for _ in range(2 + i % 5)]
    n = 0
    while sum(len(t) + 8 for t in rows[-n:] if n) < 14 * shard and n < 40_000:
        rows += [f"a single text with the number {n + i}" for i in range(4000)]
        n += 4000
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(6)
    out = balanced_shards(df).collect()
    check_shards(out, df.collect(), 24, 500)
    where = defaultdict(Counter)
    for r in out:
        where[rows[r.doc_id]][r.shard] += 1
    capacity = sum(len(t) + 8 for t in rows) / 24
    hot = where.pop(rows[0])
    full = int(capacity // (len(rows[0]) + 8))
    assert len(hot) == -(-8000 // full) and sorted(hot.values())[1:] == [full] * (len(hot) - 1)
    assert len(where[rows[8000]]) == 1
    assert all(len(c) == 1 for t, c in where.items() if sum(c.values()) > 1)


def test_rounds_gather_what_is_scattered(spark):
    rng = np.random.default_rng(6)
    rows = [(i, f"key {i % 700}", int(10 + i % 700), int(rng.integers(0, 12))) for i in range(7000)]
    df = spark.createDataFrame(rows, "rid long, key string, size long, shard int")
    total = sum(r[2] for r in rows)
    where, load = defaultdict(Counter), Counter()
    for r in propagate(df, np.zeros(12), 1.02 * total / 12).collect():
        where[r.key][r.shard] += 1
        load[r.shard] += r["size"]
    kept = sum(k * k for c in where.values() for k in c.values()) / sum(sum(c.values()) ** 2 for c in where.values())
    assert kept > 0.9 and max(load.values()) <= 1.06 * total / 12


def test_parts_of_groups_cover_them_and_fit():
    rng = np.random.default_rng(7)
    for _ in range(100):
        shards = int(rng.integers(1, 9))
        groups = [(f"k{i}", int(n), int(n * e)) for i, (n, e) in enumerate(rng.integers(1, 60, (rng.integers(0, 12), 2)))]
        capacity = sum(g[2] for g in groups) / shards
        parts, loads = place_groups(groups, shards, capacity)
        size = {k: b // n for k, n, b in groups}
        for k, n, _ in groups:
            mine = sorted(p[1:3] for p in parts if p[0] == k)
            assert [a for a, _ in mine] + [n] == [0] + [b for _, b in mine]
        assert all(abs(loads[s] - sum((b - a) * size[k] for k, a, b, x in parts if x == s)) < 1e-6 for s in range(shards))
        assert max(loads, default=0) <= capacity + max(size.values(), default=0)


def test_shards_of_awkward_rows(awkward, nothing):
    out = balanced_shards(awkward, shards=3).collect()
    check_shards(out, awkward.collect(), 3, 10**9)
    assert balanced_shards(nothing).count() == 0


def test_quotas_never_overfill():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = rng.integers(2, 9)
        wishes, loads = rng.integers(0, 1000, (n, n)).astype(float), rng.integers(500, 1500, n).astype(float)
        np.fill_diagonal(wishes, 0)
        x = quotas(wishes, loads, 1200.0)
        after = loads + x.sum(0) - x.sum(1)
        assert (x <= wishes).all() and (after <= np.maximum(1200, loads) + n + 1).all()


def test_groups_are_gathered_from_a_start_that_does_not_know_them(spark, documents):
    """Kept links against the most that any placement keeps: all of them, as no group here exceeds a shard."""
    from itertools import combinations
    rows = [(i, f"text {i % 40} " * 3) for i in range(200)] + [(1000 + i, f"alone {i} " * 5) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = {r.doc_id: r.shard for r in balanced_shards(docs, 8).collect()}
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    links = [p for g in groups.values() for p in combinations(g, 2)]
    kept = sum(out[a] == out[b] for a, b in links)
    assert len(links) == 400 and kept >= 0.98 * len(links), kept
