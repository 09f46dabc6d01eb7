"""Footprints of pixels, covers of boxes, coordinate-system texts, and extents from file footers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lodestar.functions.crs import parse_wkt, projection_of
from lodestar.functions.raster import TransverseMercator, project_utm
from lodestar.operators.extent import scene_extent
from lodestar.operators.grid import GridSpec, box_cover, pixel_footprint, scene_frame_join
from lodestar.plans.fixtures import utm_text
from lodestar.plans.mineral_map import mineral_map
from lodestar.sources.pixels import extent_from_files, footer_statistics, write_pixels

SPEC = GridSpec(res=10.0, width=4, height=3)


def extent_df(spark, minx=0.0, maxx=100.0, miny=0.0, maxy=60.0):
    return spark.createDataFrame([(minx, maxx, miny, maxy)], "minx double, maxx double, miny double, maxy double")


# ---- footprints ----------------------------------------------------------------

def test_pixels_of_two_cells_leave_no_hole(spark):
    px = spark.createDataFrame([(20.0 * i + 10, 20.0 * j + 10) for i in range(5) for j in range(3)], "x double, y double")
    rows = pixel_footprint(px, extent_df(spark), SPEC, 20.0).collect()
    assert {(r.gx, r.gy) for r in rows} == {(i, j) for i in range(10) for j in range(6)}
    assert len(rows) == 60 and all(r.weight == 1.0 for r in rows)
    assert {(r.frame_col, r.cell_col) for r in rows if r.gx == 9} == {(2, 1)}


def test_weights_are_covered_areas(spark):
    rng = random.Random(3)
    px = [(i, rng.uniform(0, 100), rng.uniform(0, 60), rng.choice([3.0, 10.0, 25.0, 61.0])) for i in range(80)]
    df = pixel_footprint(spark.createDataFrame(px, "i int, x double, y double, side double"), extent_df(spark), SPEC, "side")
    got = {(r.i, r.gx, r.gy): r.weight for r in df.collect()}
    want = {}
    for i, x, y, side in px:
        for gx in range(10):
            for gy in range(6):
                w = min(x + side / 2, gx * 10 + 10, 100) - max(x - side / 2, gx * 10, 0)
                h = min(y + side / 2, 60 - gy * 10, 60) - max(y - side / 2, 50 - gy * 10, 0)
                if w > 1e-9 and h > 1e-9:
                    want[i, gx, gy] = w * h / 100
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-9) for k in want)


def test_footprints_outside_the_extent(spark):
    px = spark.createDataFrame([(50.0, 30.0), (150.0, 30.0), (None, 1.0)], "x double, y double")
    assert pixel_footprint(px, extent_df(spark), SPEC, 20.0, outside="clip").select("x").distinct().count() == 1
    with pytest.raises(Exception, match="pixel outside the extent"):
        pixel_footprint(px, extent_df(spark), SPEC, 20.0).collect()
    assert pixel_footprint(px, extent_df(spark), SPEC, 0.0, outside="clip").count() == 0


def test_map_with_footprints_has_no_holes(spark):
    px = spark.createDataFrame([(1, 20.0 * i + 10, 20.0 * j + 10, i, 2.0, 1.0, 1.0, 1.0) for i in range(5) for j in range(3)],
                               "scene int, x double, y double, acq int, b4 double, b6 double, b2 double, b3 double")
    holes = mineral_map(px, SPEC, pixel_size=20.0).mosaic.count()
    whole = mineral_map(px, SPEC, pixel_size=20.0, footprint=True).mosaic.count()
    assert holes == 15 and whole == 60


# ---- covers --------------------------------------------------------------------

def cover(spark, boxes):
    df = spark.createDataFrame([(i, *b) for i, b in enumerate(boxes)], "i int, a int, b int, c int, d int")
    return box_cover(df, F.col("a"), F.col("b"), F.col("c"), F.col("d")).collect()


def test_covers_fill_each_box_without_overlap(spark):
    rng = random.Random(1)
    boxes = [(0, 0, 0, 0), (5, 4, 0, 9), (0, 15, 0, 15), (3, 3, 0, 40), (1, 62, 1, 30)]
    for _ in range(60):
        a, c = rng.randint(0, 30), rng.randint(0, 30)
        boxes.append((a, a + rng.randint(0, 25), c, c + rng.randint(0, 25)))
    seen = {}
    for r in cover(spark, boxes):
        side = 1 << r.level
        for col in range(r.cell_col * side, (r.cell_col + 1) * side):
            for row in range(r.cell_row * side, (r.cell_row + 1) * side):
                assert (r.i, col, row) not in seen
                seen[r.i, col, row] = 1
    assert set(seen) == {(i, col, row) for i, (a, b, c, d) in enumerate(boxes) for col in range(a, b + 1) for row in range(c, d + 1)}


def test_cover_grows_with_the_border(spark):
    counts = [len(cover(spark, [(1, n, 1, n)])) for n in (100, 200, 400)]
    assert counts[2] < 12 * 400 and counts[2] / counts[1] < 2.3 and counts[1] / counts[0] < 2.3


def test_one_huge_scene_sends_few_rows(spark):
    ext = extent_df(spark, 0.0, 40 * 300.0, 0.0, 30 * 300.0)  # 300 x 300 frames
    scenes = spark.createDataFrame([(1, 0.0, 12000.0, 0.0, 9000.0), (2, 41.0, 79.0, 31.0, 59.0)],
                                   "scene int, minx double, maxx double, miny double, maxy double")
    from lodestar.operators.grid import frame_grid
    df = scene_frame_join(scenes, ext, frame_grid(ext, SPEC), SPEC)
    assert {r.scene: r["count"] for r in df.groupBy("scene").count().collect()} == {1: 90_000, 2: 1}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "level" in plan


def test_frames_are_dealt_once_and_never_broadcast(spark):
    """Spark takes an extent's frames for one row; a broadcast of them would pass them all through the driver."""
    from lodestar.operators.grid import frame_grid
    from lodestar.operators.extent import extent_union
    ext = extent_union(extent_df(spark, 0.0, 40 * 300.0, 0.0, 30 * 300.0))
    scenes = spark.createDataFrame([(1, 41.0, 11000.0, 31.0, 8000.0)], "scene int, minx double, maxx double, miny double, maxy double")
    frames = frame_grid(ext, SPEC)
    assert frames.rdd.getNumPartitions() > 1
    plan = scene_frame_join(scenes, ext, frames, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_blocks_meet_scenes_before_they_list_frames(spark):
    """every frame of the grid was shuffled and sorted; a large extent's filled the disks."""
    from lodestar.operators.grid import BLOCK_LEVEL, frame_grid
    ext = extent_df(spark, 0.0, 40 * 150.0, 0.0, 30 * 70.0)  # 150 x 70 frames, several blocks
    rng = random.Random(7)
    boxes = [(0, 0.0, 6000.0, 0.0, 2100.0), (1, 40.0, 80.0, 30.0, 60.0), (2, -500.0, 5.0, 2000.0, 9000.0), (3, 7000.0, 8000.0, 0.0, 9.0)]
    for i in range(4, 40):
        x, y = rng.uniform(-100, 6000), rng.uniform(-100, 2100)
        boxes.append((i, x, x + rng.choice([1.0, 90.0, 3000.0]), y, y + rng.choice([1.0, 70.0, 1500.0])))
    boxes.append(boxes[5])  # a scene that comes twice
    scenes = spark.createDataFrame(boxes, "scene int, minx double, maxx double, miny double, maxy double")
    frames = frame_grid(ext, SPEC)
    df = scene_frame_join(scenes, ext, frames, SPEC)
    got = sorted(map(tuple, df.collect()))
    assert got == sorted((s, f.frame_row, f.frame_col, f.name) for f in frames.collect() for s, a, b, c, d in boxes
                         if a < f.maxx and b > f.minx and c < f.maxy and d > f.miny)
    moved = [x for x in df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines() if "Exchange" in x]
    assert moved and not any("frame_" in x for x in moved), moved
    side = 1 << BLOCK_LEVEL
    some = frames.filter((F.col("frame_row") % 3 == 0) & (F.col("frame_col") != side))  # not a whole grid: joined as they are
    assert sorted(map(tuple, scene_frame_join(scenes, ext, some, SPEC).collect())) == [x for x in got if x[1] % 3 == 0 and x[2] != side]


# ---- coordinate systems ----------------------------------------------------------

def xy(spark, projection, lon, lat):
    e, n = project_utm(F.lit(lon), F.lit(lat), projection)
    return tuple(spark.range(1).select(e, n).first())


def test_two_zones_from_text(spark):
    assert xy(spark, projection_of(utm_text(38)), 45.0, 45.0) == pytest.approx((500000.0, 4982950.400), abs=1e-3)
    assert xy(spark, projection_of(utm_text(39)), 51.0, 45.0) == pytest.approx((500000.0, 4982950.400), abs=1e-3)
    assert xy(spark, projection_of(utm_text(39)), 54.0, 0.0) == pytest.approx((833978.557, 0.0), abs=1e-3)
    default, text = TransverseMercator(), projection_of(utm_text(38))
    assert default.constants() == text.constants() and text.unit == 1.0


def test_units_origin_and_meridian(spark):
    metres = xy(spark, projection_of(utm_text(38)), 46.5, 30.0)
    assert xy(spark, projection_of(utm_text(38, "foot", 0.3048)), 46.5, 30.0) == pytest.approx([v / 0.3048 for v in metres])
    shifted = projection_of(utm_text(38).replace('["latitude_of_origin", 0]', '["latitude_of_origin", 30]'))
    north = xy(spark, projection_of(utm_text(38)), 45.0, 30.0)[1]
    assert xy(spark, shifted, 46.5, 30.0) == pytest.approx((metres[0], metres[1] - north))
    grads = utm_text(38).replace('UNIT["degree", 0.0174532925199433]', f'UNIT["grad", {math.pi / 200}]').replace(
        '["central_meridian", 45]', '["central_meridian", 50]')
    assert xy(spark, projection_of(grads), 46.5 / 0.9, 30.0 / 0.9) == pytest.approx(metres)
    paris = utm_text(38).replace('PRIMEM["Greenwich", 0]', 'PRIMEM["Paris", 2.33722917]')
    assert xy(spark, projection_of(paris), 46.5, 30.0) == pytest.approx(metres)  # both count from Paris


def test_tree_of_a_text():
    tree = parse_wkt('A["x ""y""", -1.5e3, B(1), NORTH]')
    assert tree.word == "A" and tree.values == ['x "y"', -1500.0]
    assert [c.word for c in tree.children] == ["B", "NORTH"] and tree.children[0].values == [1.0]


@pytest.mark.parametrize("change, reason", [
    (lambda t: t[:-1], "malformed"), (lambda t: t + "]", "malformed"), (lambda t: t.replace("[", "(", 1), "malformed"),
    (lambda t: t.replace('"WGS 84"', '"WGS 84', 1), "malformed"), (lambda t: "", "malformed"), (lambda t: t + " GEOGCS", "malformed"),
    (lambda t: t.replace("Transverse_Mercator", "Lambert_Conformal_Conic_2SP"), "unsupported projection method"),
    (lambda t: t.replace("scale_factor", "azimuth"), "unknown projection parameter"),
    (lambda t: t.replace("false_northing", "false_easting"), "repeated projection parameter"),
    (lambda t: t.replace('PARAMETER["central_meridian", 45], ', ""), "central_meridian is missing"),
    (lambda t: t.replace("PROJCS", "GEOGCS", 1), "not a projected"), (lambda t: t.replace("6378137", "-1"), "out of range"),
    (lambda t: t.replace("SPHEROID", "ELLIPSOID"), "needs one SPHEROID"),
    (lambda t: t.replace("0.9996", '"0.9996"'), "no number at place 2"), (lambda t: "A[" * 60 + "1" + "]" * 60, "nested too deeply")])
def test_other_texts_are_refused(change, reason):
    with pytest.raises(ValueError, match=reason):
        projection_of(change(utm_text(38)))


def test_map_takes_a_text(spark):
    px = spark.createDataFrame([(1, 45.0, 30.0, 1, 2.0, 1.0, 1.0, 1.0), (1, 45.1, 30.1, 1, 2.0, 1.0, 1.0, 1.0)],
                               "scene int, lon double, lat double, acq int, b4 double, b6 double, b2 double, b3 double")
    one = mineral_map(px, projection=utm_text(38)).extent.first()
    assert one == mineral_map(px, projection=TransverseMercator()).extent.first()


# ---- extents from footers -----------------------------------------------------------

SCHEMA = "scene int, x double, y double, b4 double"


def test_extent_comes_from_the_footers(spark, tmp_path):
    rng = random.Random(0)
    px = spark.createDataFrame([(i % 3, rng.uniform(0, 9), rng.uniform(0, 9), 1.0) for i in range(300)], SCHEMA).repartition(4)
    path = str(tmp_path / "pixels")
    write_pixels(px, path)
    df = footer_statistics(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [" in plan and "MIN(x)" in plan and "PushedGroupBy: [scene]" in plan
    assert "ReadSchema: struct<scene:int,min(x):double" in plan  # statistics, no rows
    got = sorted(tuple(r) for r in extent_from_files(spark, path, no_nan=True).collect())
    assert got == sorted(tuple(r) for r in scene_extent(px).select("scene", "minx", "maxx", "miny", "maxy").collect())
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session stays as it was


@pytest.mark.parametrize("case", ["no coordinate", "NaN", "all NULL", "no promise"])
def test_rows_are_read_where_footers_cannot_tell(spark, tmp_path, case):
    odd = {"no coordinate": (0, 100.0, None, 1.0), "NaN": (0, 100.0, float("nan"), 1.0), "all NULL": (5, None, None, 1.0),
           "no promise": (0, 5.0, 5.0, 1.0)}[case]
    px = spark.createDataFrame([(0, 1.0, 2.0, 1.0), (1, 3.0, 4.0, 1.0), odd], SCHEMA).coalesce(1)
    path = str(tmp_path / "pixels")
    px.write.partitionBy("scene").parquet(path)
    got = extent_from_files(spark, path, no_nan=case in ("no coordinate", "all NULL"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        tuple(r) for r in scene_extent(px).select("scene", "minx", "maxx", "miny", "maxy").collect())


def test_integer_coordinates_need_no_promise(spark, tmp_path):
    px = spark.createDataFrame([(0, 1, 2), (0, 7, 8)], "scene int, x int, y int")
    write_pixels(px, str(tmp_path / "p"))
    assert tuple(extent_from_files(spark, str(tmp_path / "p"), pixel_size=2.0).first()) == (0, 0.0, 8.0, 1.0, 9.0)


def test_nan_coordinates_are_not_written(spark, tmp_path):
    px = spark.createDataFrame([(0, float("nan"), 2.0, 1.0)], SCHEMA)
    with pytest.raises(Exception, match="NaN in x"):
        write_pixels(px, str(tmp_path / "p"))


def test_footprints_are_dealt_as_pixels(spark):
    """The mosaic's aggregate needs no exchange of the cells; a footprint over several neighbourhoods is whole."""
    from lodestar.operators.mosaic import mosaic_fill, weighted_mean
    ext = extent_df(spark, 0.0, 1000.0, 0.0, 1000.0)
    spec = GridSpec(res=10.0, width=4, height=3)
    pixels = spark.createDataFrame([(320.0, 680.0, 1.0), (320.0, 680.0, 3.0), (505.0, 505.0, 5.0)], "x double, y double, v double")
    mosaic = mosaic_fill(pixel_footprint(pixels, ext, spec, 40.0), spec, weighted_mean("weight"))
    got = {(r.gx, r.gy): (r.v, r.n) for r in mosaic.collect()}
    assert {k for k, v in got.items() if v == (2.0, 2)} == {(x, y) for x in range(30, 34) for y in range(30, 34)}
    assert sorted(v for v in got.values() if v[1] == 1) == [(5.0, 1)] * 25
    plan = mosaic._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(near_x" in plan and "hashpartitioning(_cell" not in plan
