"""Projection, extents, grid placement, mosaic policies and thresholds."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from lodestar.functions.raster import binary_threshold, project_utm, vegetation_mask
from lodestar.operators.bands import apply_index, coregister, export_swir, export_vnir
from lodestar.operators.extent import extent_error, extent_format, extent_union, parse_extent, scene_extent
from lodestar.operators.grid import (GridSpec, empty_frames, frame_grid, pixel_to_frame,
                                     scene_frame_join, unplaced_pixels)
from lodestar.operators.mosaic import dense_cells, dense_summary, frame_summary, mosaic_fill
from lodestar.plans.mineral_map import mineral_map

SPEC = GridSpec()


def _extent(spark, minx, maxx, miny, maxy):
    return spark.createDataFrame([(float(minx), float(maxx), float(miny), float(maxy))],
                                 "minx double, maxx double, miny double, maxy double")


@pytest.mark.parametrize("lon,lat,e,n", [
    (45, 45, 500000.000, 4982950.400),
    (48, 0, 833978.557, 0.0),
    (46.5, 33, 640130.313, 3652286.115),
    (42, 60, 332705.179, 6655205.484),
])
def test_project_utm_check_values(spark, lon, lat, e, n):
    df = spark.createDataFrame([(float(lon), float(lat))], "lon double, lat double")
    east, north = project_utm("lon", "lat")
    r = df.select(east.alias("e"), north.alias("n")).first()
    assert abs(r["e"] - e) < 1e-3 and abs(r["n"] - n) < 1e-3


def test_parse_extent_orders_normalise(spark):
    df = spark.createDataFrame([("0 10 5 20",), ("0 10 20 5",), ("1 x 2 3",), ("1  2 3 4",), ("1 2 3",),
                                ("1 2 3 4 5",), ("",), (None,)], "t string")
    plain = df.select(*parse_extent("t", "plain")).collect()
    shell = df.select(*parse_extent("t", "shell")).collect()
    assert tuple(plain[0]) == (0.0, 10.0, 5.0, 20.0) == tuple(shell[1]) == tuple(plain[1])
    assert tuple(shell[0]) == (0.0, 10.0, 5.0, 20.0)
    assert all(tuple(r) == (None,) * 4 for r in plain[2:] + shell[2:])
    assert [r[0] for r in df.select(extent_error("t")).collect()] == [
        None, None, "number", "arity", "arity", "arity", "arity", "missing"]


def test_extent_format_refuses_fractions_when_integral(spark):
    df = spark.createDataFrame([("1.75 2.5 4.9 3.0",)], "t string").select(*parse_extent("t", "shell"))
    assert df.select(extent_format("plain")).first()[0] == "1.75 2.5 3.0 4.9"
    with pytest.raises(Exception, match="not a whole number"):
        df.select(extent_format("plain", integral=True)).collect()
    none = spark.createDataFrame([("1 2",)], "t string").select(*parse_extent("t"))
    assert none.select(extent_format("plain", integral=True)).first()[0] is None


def test_extent_union_nan_one_none(spark):
    rows = [(0.0, 10.0, 5.0, 20.0), (-5.0, 3.0, float("nan"), 1.0), (2.0, 30.0, -1.0, 4.0)]
    df = spark.createDataFrame(rows, "minx double, maxx double, miny double, maxy double")
    assert tuple(extent_union(df).first()) == (0.0, 30.0, -1.0, 20.0)
    assert tuple(extent_union(df.limit(1)).first()) == (0.0, 10.0, 5.0, 20.0)
    assert tuple(extent_union(df.filter("false")).first()) == (None, None, None, None)


def test_extent_union_is_commutative_and_idempotent(spark):
    rows = [(float(i), float(i + 3), float(-i), float(2 * i)) for i in range(20)]
    df = spark.createDataFrame(rows, "minx double, maxx double, miny double, maxy double")
    a = tuple(extent_union(df).first())
    b = tuple(extent_union(df.orderBy(F.rand(7)).repartition(5)).first())
    c = tuple(extent_union(df.unionByName(df)).first())
    assert a == b == c


def test_extent_format(spark):
    e = _extent(spark, 0, 1999, 0, 99)
    r = e.select(extent_format("plain", True).alias("p"), extent_format("shell", True).alias("s"),
                 extent_format("plain").alias("d")).first()
    assert (r["p"], r["s"]) == ("0 1999 0 99", "0 1999 99 0")
    assert r["d"] == "0.0 1999.0 0.0 99.0"


def test_zero_area_extent_has_one_frame(spark):
    frames = frame_grid(_extent(spark, 100, 100, 50, 50), SPEC).collect()
    assert len(frames) == 1 and frames[0]["name"] == "r0_c0"


def test_frame_grid_counts_and_anchor(spark):
    # 300 km x 150 km -> 3 x 2 frames of 125 km x 100 km, anchored top-left
    frames = frame_grid(_extent(spark, 0, 300000, 0, 150000), SPEC).collect()
    assert len(frames) == 6
    f = {(r["frame_row"], r["frame_col"]): r for r in frames}
    assert f[(0, 0)]["maxy"] == 150000 and f[(0, 0)]["minx"] == 0
    assert f[(1, 2)]["miny"] == 150000 - 200000 and f[(1, 2)]["maxx"] == 375000


def test_every_pixel_lands_in_exactly_one_cell_and_edges_clamp(spark):
    e = _extent(spark, 0, 1000, 0, 1000)
    pts = [(0.0, 1000.0), (1000.0, 0.0), (999.9, 0.1), (500.0, 500.0), (1000.1, 5.0)]
    df = spark.createDataFrame(pts, "x double, y double")
    got = {(r["x"], r["y"]): (r["gx"], r["gy"]) for r in pixel_to_frame(df, e, SPEC, outside="clip").collect()}
    assert got[(0.0, 1000.0)] == (0, 0)
    assert got[(1000.0, 0.0)] == (1, 1)   # max-x / min-y edge -> last cell
    assert got[(999.9, 0.1)] == (1, 1)
    assert got[(500.0, 500.0)] == (1, 1)
    assert (1000.1, 5.0) not in got       # outside the extent
    with pytest.raises(Exception, match="pixel outside the extent"):
        pixel_to_frame(df, e, SPEC).collect()
    odd = spark.createDataFrame(pts + [(None, 1.0), (1.0, float("nan"))], "x double, y double")
    assert sorted((str(r["x"]), r["reason"]) for r in unplaced_pixels(odd, e).collect()) == [
        ("1.0", "no coordinates"), ("1000.1", "outside"), ("None", "no coordinates")]


def test_no_data_never_beats_a_valid_pixel(spark):
    rows = [(0, 0, 1, 0.33), (0, 0, 2, float("nan")), (0, 0, 3, None), (1, 0, 1, float("nan"))]
    df = spark.createDataFrame(rows, "gx int, gy int, acq int, v double")
    for policy in ("latest", "first", "max", "min", "mean"):
        got = [(r["gx"], r["v"], r["n"]) for r in mosaic_fill(df, SPEC, policy=policy).collect()]
        assert got == [(0, 0.33, 1)]
    bits = df.select(binary_threshold("v")).collect()
    assert [r[0] for r in bits] == [1, None, None, None]


def test_dense_frames_cover_every_cell(spark):
    spec = GridSpec(10.0, 3, 2)
    frames = frame_grid(_extent(spark, 0, 60, 0, 20), spec)
    cells = spark.createDataFrame([(0, 1, 1, 2, 0.5, 1)],
                                  "frame_row int, frame_col int, cell_row int, cell_col int, v double, bit int")
    rows = dense_cells(cells, frames, spec).collect()
    assert len(rows) == 12 and {(r["frame_row"], r["frame_col"]) for r in rows} == {(0, 0), (0, 1)}
    assert [tuple(r) for r in rows if r["v"] is not None] == [(0, 1, 1, 2, 0.5, 1)]
    assert sum(r["bit"] is None for r in rows) == 11
    got = dense_summary(frame_summary(cells), frames).orderBy("frame_col").collect()
    assert [tuple(r) for r in got] == [(0, 0, 0, 0, None), (0, 1, 1, 1, 0.5)]


def test_cells_and_frames_of_large_grid(spark):
    e = _extent(spark, 0, 250 * 500 * 2, 0, 200 * 500 * 2)
    df = spark.createDataFrame([(125000.0 + 250, 100000.0 - 250)], "x double, y double")
    r = pixel_to_frame(df, e, SPEC).first()
    assert (r["gx"], r["gy"]) == (250, 200)
    assert (r["frame_col"], r["frame_row"], r["cell_col"], r["cell_row"]) == (1, 1, 0, 0)


def test_empty_frames_cover_frame(spark):
    cells = empty_frames(frame_grid(_extent(spark, 0, 10, 0, 10), GridSpec(10.0, 3, 2)), GridSpec(10.0, 3, 2))
    rows = cells.collect()
    assert len(rows) == 6 and all(r["v"] is None for r in rows)
    assert {(r["x"], r["y"]) for r in rows} == {(5.0, 5.0), (15.0, 5.0), (25.0, 5.0),
                                                (5.0, -5.0), (15.0, -5.0), (25.0, -5.0)}


def test_empty_frames_keep_one_row_of_cells_at_a_time(spark):
    """No generated stage makes both a frame's rows and their cells: it would keep the whole frame (F3)."""
    spec = GridSpec(10.0, 3, 2)
    cells = empty_frames(frame_grid(_extent(spark, 0, 60, 0, 40), spec), spec)
    rows = sorted(tuple(r) for r in cells.collect())
    assert rows == sorted((r, c, i, j, c * 30.0 + (j + 0.5) * 10, 40.0 - r * 20 - (i + 0.5) * 10, None)
                          for r in range(2) for c in range(2) for i in range(2) for j in range(3))
    final = cells._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    stages = re.findall(r"\*\((\d+)\) Generate explode", final)
    assert stages and len(stages) == len(set(stages)), final


def test_scene_frame_join_open_boxes(spark):
    spec = GridSpec(10.0, 10, 10)   # 100 x 100 frames
    ext = _extent(spark, 0, 300, 0, 200)
    frames = frame_grid(ext, spec)
    scenes = spark.createDataFrame(
        [("a", 0.0, 100.0, 100.0, 200.0),   # exactly frame r0 c0; touches neighbours only at edges
         ("b", 150.0, 250.0, 50.0, 150.0),  # four frames
         ("c", 500.0, 600.0, 0.0, 10.0)],   # outside the grid
        "scene string, minx double, maxx double, miny double, maxy double")
    got = sorted((r["scene"], r["frame_row"], r["frame_col"])
                 for r in scene_frame_join(scenes, ext, frames, spec).collect())
    assert got == [("a", 0, 0), ("b", 0, 1), ("b", 0, 2), ("b", 1, 1), ("b", 1, 2)]


def _pixels(spark):
    t = dt.datetime(2020, 1, 1)
    rows = [  # scene, x, y, acq, b2, b3, b4, b6
        ("s1", 250.0, 250.0, t, 1.0, 1.0, 3.0, 1.0),                           # v = 0.5
        ("s2", 250.0, 250.0, t + dt.timedelta(days=1), 1.0, 1.0, 1.0, 3.0),    # v = -0.5, later
        ("s3", 250.0, 250.0, t + dt.timedelta(days=2), 1.0, 2.0, 9.0, 1.0),    # vegetated: masked out
        ("s1", 750.0, 250.0, t, 1.0, 1.0, 2.0, 2.0),                           # v = 0
        ("s1", 1250.0, 250.0, t, 1.0, 1.0, 0.0, 0.0),                          # v = NULL (0/0)
    ]
    return spark.createDataFrame(rows, "scene string, x double, y double, acq timestamp, "
                                       "b2 double, b3 double, b4 double, b6 double")


def test_index_and_mask(spark):
    idx = apply_index(_pixels(spark), keep=["scene", "x"]).collect()
    assert len(idx) == 4
    assert sorted((r["scene"], r["x"], r["v"]) for r in idx if r["v"] is not None) == \
        [("s1", 250.0, 0.5), ("s1", 750.0, 0.0), ("s2", 250.0, -0.5)]


@pytest.mark.parametrize("policy,expected", [
    ("latest", -0.5), ("first", 0.5), ("max", 0.5), ("min", -0.5), ("mean", 0.0), ("count", 2.0)])
def test_overlap_policies(spark, policy, expected):
    m = mineral_map(_pixels(spark), SPEC, overlap=policy, order=("acq", "scene"))
    cells = {(r["gx"], r["gy"]): r for r in m.mosaic.collect()}
    assert cells[(0, 0)]["v"] == expected and cells[(0, 0)]["n"] == 2
    assert (2, 0) not in cells   # NULL index is no-data, never a cell value


def test_mosaic_is_invariant_to_partitioning(spark):
    from lodestar.plans import fixtures as X
    obs = X.observations(X.reader(spark, "/root/testdata/sf0.001"))
    ref = None
    for n in (1, 7, 64):
        m = mineral_map(obs.repartition(n), SPEC, order=("acq", "l_orderkey", "scene"))
        got = sorted(map(tuple, m.mosaic.collect()))
        ref = ref or got
        assert got == ref


def test_binary_threshold(spark):
    df = spark.createDataFrame([(0.3,), (0.29999,), (None,), (0.9,)], "v double")
    assert [r[0] for r in df.select(binary_threshold("v")).collect()] == [1, 0, None, 1]


def test_vegetation_mask_zero_red(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.35), (1.0, 1.36)], "b2 double, b3 double")
    assert [r[0] for r in df.select(vegetation_mask()).collect()] == [False, True, False]


def test_band_groups_and_coregistration(spark):
    px = spark.createDataFrame([("s", 0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9)],
                               "scene string, x long, y long, b1 int, b2 int, b3n int, b4 int, "
                               "b5 int, b6 int, b7 int, b8 int, b9 int")
    assert export_vnir(px).columns == ["scene", "x", "y", "b1", "b2", "b3n"]
    assert export_swir(px).columns == ["scene", "x", "y", "b4", "b5", "b6", "b7", "b8", "b9"]
    vnir = spark.createDataFrame([("s", x, y, float(x + y)) for x in range(4) for y in range(2)],
                                 "scene string, x long, y long, b2 double")
    swir = spark.createDataFrame([("s", 0, 0, 10.0), ("s", 1, 0, 20.0), ("t", 0, 0, 1.0)],
                                 "scene string, px long, py long, b4 double")
    got = sorted(map(tuple, coregister(vnir, swir).collect()))
    assert got == [("s", 0, 0, 1.0, 4, 10.0), ("s", 1, 0, 3.0, 4, 20.0)]


def test_scene_extent_half_pixel(spark):
    r = scene_extent(_pixels(spark), pixel_size=500.0).filter("scene = 's1'").first()
    assert (r["minx"], r["maxx"], r["miny"], r["maxy"]) == (0.0, 1500.0, 0.0, 500.0)


def test_tile_pixels_layout(spark):
    from lodestar.sources.tiles import tile_pixels
    tiles = spark.createDataFrame(
        [("s", 0.0, 20.0, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [0.0] * 6)],
        "scene string, tile_minx double, tile_maxy double, a array<double>, b array<double>")
    got = sorted((r["x"], r["y"], r["a"], r["b"]) for r in
                 tile_pixels(tiles, ["a", "b"], width=3, height=2, res=10.0).collect())
    # 3 x 2 tile: values 1..6 row-major from the top-left
    assert [(x, y, a) for x, y, a, _ in got] == [
        (5.0, 5.0, 4.0), (5.0, 15.0, 1.0), (15.0, 5.0, 5.0), (15.0, 15.0, 2.0),
        (25.0, 5.0, 6.0), (25.0, 15.0, 3.0)]
    assert all(b == 0.0 for *_, b in got)
    long = tiles.withColumn("a", F.expr("concat(a, array(7.0D))")).withColumn("b", F.expr("concat(b, array(0.0D))"))
    for wrong in (long, tiles.withColumn("b", F.expr("slice(b, 1, 5)"))):
        with pytest.raises(Exception, match="tile does not hold 3 x 2"):
            tile_pixels(wrong, ["a", "b"], width=3, height=2, res=10.0).collect()


def test_empty_input_fails_the_map(spark):
    # empty at run time (a literal false filter is folded away by the optimizer);
    # raised inside the extent subquery, so it may surface as a wrapped JVM error
    empty = _pixels(spark).filter(F.col("x") < F.lit(-1e30))
    with pytest.raises(Exception) as err:
        mineral_map(empty, SPEC, order=("acq",)).summary.collect()
    assert "empty extent" in str(err.value)


def test_given_extent_matches_computed_and_must_be_one_row(spark):
    px = _pixels(spark)
    computed = mineral_map(px, SPEC, order=("acq",))
    ext_row = computed.extent.first()
    given = _extent(spark, ext_row["minx"], ext_row["maxx"], ext_row["miny"], ext_row["maxy"])
    m = mineral_map(px, SPEC, order=("acq",), extent=given)
    assert sorted(map(tuple, m.mosaic.collect())) == sorted(map(tuple, computed.mosaic.collect()))
    two = given.unionByName(given)
    with pytest.raises(Exception):
        mineral_map(px, SPEC, order=("acq",), extent=two).mosaic.collect()


def test_hot_cell_latest_is_global_max(spark):
    """A third of the pixels land in one cell, spread over many partitions:
    the latest policy still picks the single greatest (order, v)."""
    rows = []
    t = dt.datetime(2020, 1, 1)
    for i in range(3000):
        hot = i % 3 == 0
        x = 250.0 if hot else 250.0 + 500.0 * (i % 40)
        y = 250.0 if hot else 250.0 + 500.0 * (i // 40)
        rows.append((f"s{i % 5}", x, y, t + dt.timedelta(seconds=i % 997), 1.0, 1.0, 2.0 + i % 7, 1.0))
    px = spark.createDataFrame(rows, "scene string, x double, y double, acq timestamp, "
                                     "b2 double, b3 double, b4 double, b6 double").repartition(16)
    m = mineral_map(px, SPEC, order=("acq", "scene"))
    top = max((r for r in rows if r[1] == 250.0 and r[2] == 250.0),
              key=lambda r: (r[3], r[0], (r[6] - r[7]) / (r[6] + r[7])))
    ext = m.extent.first()
    gy_hot = int((ext["maxy"] - 250.0) // 500.0)
    cell = [r for r in m.mosaic.collect() if r["gx"] == 0 and r["gy"] == gy_hot][0]
    assert cell["n"] == sum(1 for r in rows if r[1] == 250.0 and r[2] == 250.0)
    assert cell["v"] == (top[6] - top[7]) / (top[6] + top[7])
