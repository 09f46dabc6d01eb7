"""Hard negatives against brute force over slices and blocks, ties, zero and long vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, is_anchor, positives=5, negatives=3):
    """Rows (id, vector, label) in any order; ids are distinct."""
    q = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows
         if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, a, label in q:
        if not is_anchor(i):
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b)), j, m) for j, b, m in q if len(b) == len(a) and j != i)
        for s, j, _ in [x for x in scores if x[2] == label][:positives]:
            fits = [(n, k) for n, k, m in scores if m != label and 50 * -s <= 100 * -n <= 95 * -s]
            out += [(i, j, r, k, -s, -n) for r, (n, k) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in hn.hard_negatives(df, F.col("vec_id") % 5 == 0).collect())


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(hn, "SLICE", 12)
    monkeypatch.setattr(hn, "BLOCK", 30)
    monkeypatch.setattr(hn, "STRIP", 16)


def test_equals_brute_force_over_many_slices_and_blocks(spark, small_parts):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((6, 8))
    rows = [(i, (centres[rng.integers(6)] + 0.4 * rng.standard_normal(8)).tolist(), int(rng.integers(4))) for i in range(400)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows, lambda i: i % 5 == 0) and len(got) > 500


def test_ties_zero_and_unusable_vectors(spark, small_parts):
    rng = np.random.default_rng(2)
    base = [rng.integers(-2, 3, 4).astype(float).tolist() for _ in range(12)]
    rows = [(i, base[i % 12], i % 3) for i in range(120)]  # many equal vectors and scores
    rows += [(200, [0.0] * 4, 0), (205, [0.0] * 4, 1), (210, None, 1), (215, [1.0, None, 0.0, 0.0], 1), (220, [float("nan")] * 4, 2),
             (225, [1.0] * 4, None), (None, [1.0] * 4, 1), (230, [1.0, 2.0], 0), (231, [1.0, 2.0], 0), (232, [1.0, 1.4], 1),
             (235, [], 0), (236, [], 0), (237, [], 1), (240, [float("inf"), 0.0, 0.0, 0.0], 0)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows, lambda i: i % 5 == 0)


def test_large_components_are_scored_exactly(spark, small_parts):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(4) * 2.0 ** 19 + 2.0 ** 18).tolist(), i % 2) for i in range(60)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows, lambda i: i % 5 == 0)


def test_a_third_of_all_rows_alike(spark, small_parts):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 0.5, 0.0] if i % 3 == 0 else rng.standard_normal(3).tolist(), i % 4) for i in range(300)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows, lambda i: i % 5 == 0)


def test_empty_table_extra_columns_and_repeated_rows(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [0.8, 0.1], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit(1), "rid": F.lit(2), "q": F.lit(None), "id": F.lit(1)})
    # the second row with the anchor's id is its positive, for each of the two
    assert found(df) == [(0, 0, 1, 1, 65536, 256 * 204)] * 2
    assert found(df.where("false")) == []


def test_list_is_certified_before_its_end():
    import pandas as pd
    rng = np.random.default_rng(5)
    near = rng.standard_normal((20, 6)) * 0.05 + np.array([10, 0, 0, 0, 0, 0])
    far = rng.standard_normal((2000, 6)) * 0.05 - np.array([10, 0, 0, 0, 0, 0])
    order, bounds = hn.shared_list(near, np.vstack([far, near]))
    assert set(order[:20]) == set(range(2000, 2020)) and (bounds[20:] < 0).all()
    scores = near @ np.vstack([far, near]).T
    assert (scores[:, order] <= np.sqrt((near ** 2).sum(1))[:, None] * bounds + 1e-9).all()
    part = pd.DataFrame({"arid": [0], "label": [0], "q": [near[0]], "lo": [[hn.NONE]], "hi": [[-hn.NONE]], "need": [[hn.NONE]]})
    cands = pd.DataFrame({"rid": range(1, 2021), "id": range(1, 2021), "label": 0, "q": list(np.vstack([far, near]))})
    assert set(hn.walk(part, cands, 3, True)["id"]) <= set(range(2001, 2021))
