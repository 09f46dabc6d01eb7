"""Filling a mosaic scene by scene: any order, twice, untouched frames, other writers; and overlap policies."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lodestar.operators.grid import GridSpec, pixel_to_frame
from lodestar.operators.mosaic import (OverlapPolicy, cell_states, finished, merged_states, mosaic_fill, overlap_policy,
                                       weighted_mean)
from lodestar.sinks.mosaic_store import CommitConflict, MosaicStore

SPEC = GridSpec(res=10.0, width=5, height=4)
PIXELS = "scene int, x double, y double, acq int, v double"


@pytest.fixture(scope="module")
def extent(spark):
    return spark.createDataFrame([(0.0, 200.0, 0.0, 160.0)], "minx double, maxx double, miny double, maxy double")


def pixels(spark, extent, boxes, seed=0):
    """Scenes over boxes (x0, x1, y0, y1), with NULL and NaN values and equal acquisition times."""
    rng, rows = random.Random(seed), []
    for scene, (x0, x1, y0, y1) in boxes.items():
        for _ in range(120):
            v = rng.choice([None, float("nan")] + [round(rng.uniform(0, 1), 2)] * 6)
            rows.append((scene, rng.uniform(x0, x1), rng.uniform(y0, y1), rng.randint(1, 3), v))
    return pixel_to_frame(spark.createDataFrame(rows, PIXELS), extent, SPEC)


BOXES = {1: (0, 90, 0, 90), 2: (40, 140, 30, 120), 3: (100, 200, 80, 160), 4: (0, 40, 100, 160)}
ORDER = ("acq", "scene", "x", "y")


def rows(df):
    return sorted((r.gx, r.gy, r.frame_row, r.frame_col, r.cell_row, r.cell_col, round(r.v, 9), r.n) for r in df.collect())


def new_store(spark, tmp_path, extent, policy=None, name="store"):
    return MosaicStore(spark, str(tmp_path / name), policy or overlap_policy("latest", ORDER), extent, SPEC, order=("acq", "x", "y"))


def part(placed, *scenes):
    return placed.filter(F.col("scene").isin(list(scenes)))


@pytest.mark.parametrize("policy", ["latest", "mean"])
def test_any_order_and_twice_equals_the_full_mosaic(spark, extent, tmp_path, policy):
    placed = pixels(spark, extent, BOXES).cache()
    want = rows(mosaic_fill(placed, SPEC, policy, order=ORDER))
    orders = [((2, 4), (2, 1), (3, 1)), ((3,), (1, 4), (2,))]
    for k, order in enumerate(orders if policy == "latest" else orders[:1]):
        store = new_store(spark, tmp_path, extent, overlap_policy(policy, ORDER), f"s{k}")
        assert store.mosaic() is None
        for scenes in order:
            assert store.add(part(placed, *scenes))
        assert store.add(part(placed, 1, 2, 3, 4)) is None  # all there already
        assert rows(store.mosaic()) == want


def test_untouched_frames_are_not_written_again(spark, extent, tmp_path):
    placed = pixels(spark, extent, BOXES)
    store = new_store(spark, tmp_path, extent)
    first = store.add(part(placed, 1, 3))
    files = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path) for f in fs}
    store.add(part(placed, 4))
    touched = {(r.frame_row, r.frame_col) for r in part(placed, 4).select("frame_row", "frame_col").distinct().collect()}
    versions = {(r.frame_row, r.frame_col): r.version for r in store.frame_versions().collect()}
    assert {f for f, v in versions.items() if v == 1} <= touched and any(v == 0 for v in versions.values())
    written = {(r.frame_row, r.frame_col) for r in spark.read.parquet(f"{store.path}/states/token={store.commits()[1]}").collect()}
    assert written <= touched
    assert all(os.path.getmtime(f) == t for f, t in files.items()) and store.commits()[0] == first


def test_a_scene_with_other_pixels_is_refused(spark, extent, tmp_path):
    store = new_store(spark, tmp_path, extent)
    store.add(part(pixels(spark, extent, BOXES), 1))
    before = rows(store.mosaic())
    with pytest.raises(Exception, match="stored with other pixels: 1"):
        store.add(part(pixels(spark, extent, BOXES, seed=5), 1, 2))
    assert rows(store.mosaic()) == before and len(store.commits()) == 1


def test_another_grid_is_refused(spark, extent, tmp_path):
    new_store(spark, tmp_path, extent).add(part(pixels(spark, extent, BOXES), 1))
    other = MosaicStore(spark, str(tmp_path / "store"), overlap_policy("max"), extent, GridSpec(res=5.0, width=5, height=4))
    with pytest.raises(ValueError, match="another grid"):
        other.mosaic()


def racing(store, monkeypatch, action):
    """Run ``action`` once, just before the store takes its version."""
    take, done = store._commit, []

    def late(version, token):
        if not done:
            done.append(1)
            action()
        return take(version, token)

    monkeypatch.setattr(store, "_commit", late)


def test_writers_of_other_frames_both_count(spark, extent, tmp_path, monkeypatch):
    placed = pixels(spark, extent, {1: (0, 40, 0, 30), 2: (160, 200, 130, 160)})
    one, two = new_store(spark, tmp_path, extent), new_store(spark, tmp_path, extent)
    racing(one, monkeypatch, lambda: two.add(part(placed, 2)))
    one.add(part(placed, 1))
    assert len(one.commits()) == 2
    assert rows(one.mosaic()) == rows(mosaic_fill(placed, SPEC, "latest", order=ORDER))


def test_writers_of_the_same_frames_conflict_and_can_repeat(spark, extent, tmp_path, monkeypatch):
    placed = pixels(spark, extent, BOXES)
    one, two = new_store(spark, tmp_path, extent), new_store(spark, tmp_path, extent)
    racing(one, monkeypatch, lambda: two.add(part(placed, 2)))
    with pytest.raises(CommitConflict, match="same frames"):
        one.add(part(placed, 1))
    assert len(one.commits()) == 1
    one.add(part(placed, 1))
    assert rows(one.mosaic()) == rows(mosaic_fill(part(placed, 1, 2), SPEC, "latest", order=ORDER))


def test_a_commit_that_never_ended_counts_for_nothing(spark, extent, tmp_path):
    placed = pixels(spark, extent, BOXES)
    store = new_store(spark, tmp_path, extent)
    store.add(part(placed, 1))
    (tmp_path / "store" / "commits" / "0000000001").touch()  # a writer that died
    store.add(part(placed, 2))
    assert store.commits()[1] is None
    assert rows(store.mosaic()) == rows(mosaic_fill(part(placed, 1, 2), SPEC, "latest", order=ORDER))


def test_a_null_scene_and_no_pixels(spark, extent, tmp_path):
    placed = pixels(spark, extent, BOXES).withColumn("scene", F.when(F.col("scene") != 2, F.col("scene")))
    store = new_store(spark, tmp_path, extent)
    assert store.add(placed.where("false")) is None
    store.add(placed)
    assert store.add(placed) is None
    assert sum(r.n for r in store.mosaic().collect()) == placed.filter(F.col("v").isNotNull() & ~F.isnan("v")).count()


@pytest.mark.parametrize("policy", ["latest", "first", "max", "min", "mean", "count"])
def test_states_of_parts_merge_to_the_whole(spark, extent, policy):
    placed = pixels(spark, extent, BOXES)
    p = overlap_policy(policy, ORDER)
    parts = [cell_states(part(placed, s), p, SPEC) for s in BOXES]
    want = rows(mosaic_fill(placed, SPEC, policy, order=ORDER))
    assert rows(mosaic_fill(placed, SPEC, p)) == want
    for order in (parts[:3], parts[::-1]):
        states = order[0]
        for more in order[1:]:
            states = merged_states(states.unionByName(more), p, SPEC)
        assert rows(finished(states, p)) == (want if len(order) == 4 else rows(mosaic_fill(part(placed, 1, 2, 3), SPEC, p)))


def test_a_callers_policy_is_aggregated_partially(spark, extent):
    spread = OverlapPolicy(lambda v: {"lo": F.min(v), "hi": F.max(v)},
                           lambda s: {"lo": F.min(s("lo")), "hi": F.max(s("hi"))}, lambda s: s("hi") - s("lo"))
    placed = pixels(spark, extent, BOXES)
    df = mosaic_fill(placed, SPEC, spread)
    want = {}
    for r in placed.collect():
        if r.v is not None and r.v == r.v:
            want.setdefault((r.gx, r.gy), []).append(r.v)
    assert {(r.gx, r.gy): r.v for r in df.collect()} == {k: max(v) - min(v) for k, v in want.items()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_max" in plan


def test_weighted_mean_without_weight_has_no_value(spark, extent):
    placed = pixels(spark, extent, {1: (0, 10, 0, 10)}).withColumn("w", F.lit(0.0))
    assert [r.v for r in mosaic_fill(placed, SPEC, weighted_mean("w")).collect()] == [None]


def test_unknown_policies_are_refused():
    with pytest.raises(ValueError):
        overlap_policy("median")
    with pytest.raises(ValueError):
        overlap_policy("latest")


def test_reading_deals_no_state_anew(spark, extent, tmp_path):
    """The list of live frames comes to the states; they cross no exchange to be read."""
    placed = pixels(spark, extent, BOXES).cache()
    store = new_store(spark, tmp_path, extent)
    for scenes in ((1, 4), (2, 3)):
        store.add(part(placed, *scenes))
    conf = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "-1")  # as for tables above the threshold
    try:
        states = store.states()
        assert "SortMergeJoin" not in states._jdf.queryExecution().executedPlan().toString()
        assert rows(store.mosaic()) == rows(mosaic_fill(placed, SPEC, "latest", order=ORDER))
    finally:
        spark.conf.set(conf, old)
