"""Sources, sinks and materialisation round trips (no database is started)."""

import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lodestar.plans import fixtures as X
from lodestar.plans.mineral_map import mineral_map
from lodestar.sinks.frames import frame_sink, materialise, read_frames
from lodestar.sinks.jdbc import STORED_COLUMNS, jdbc_frame, tolerant_write
from lodestar.sources.scenes import scene_listing
from lodestar.sources.text import catalog_scan
from tests.test_decode import GOOD, _line


def test_scene_listing_top_level_suffix_only(spark):
    d = tempfile.mkdtemp(prefix="scenes-")
    os.makedirs(os.path.join(d, "sub"))
    os.makedirs(os.path.join(d, "k=1"))
    for name in ["a.hdf", "b.HDF", "c.tif", "x.hdf.tif", "a2.hdf", "sub/d.hdf", "k=1/e.hdf"]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write("hdf")
    df = scene_listing(spark, d)
    assert sorted(r["name"] for r in df.collect()) == ["a.hdf", "a2.hdf"]
    with pytest.raises(ValueError):
        scene_listing(spark, os.path.join(d, "a.hdf"))
    assert "content" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_catalog_scan_reads_lines_and_missing_path_fails(spark):
    d = tempfile.mkdtemp(prefix="lines-")
    with open(os.path.join(d, "part1.txt"), "w") as fh:
        fh.write(GOOD + "\n" + "short,line\n")
    assert catalog_scan(spark, d).count() == 2
    with pytest.raises(AnalysisException):
        catalog_scan(spark, os.path.join(d, "missing")).count()


def test_tolerant_write_reasons(spark):
    lines = [GOOD, GOOD, _line(data_url="http://x/2"), _line(data_url="http://x/3"),
             "a,b", _line(band_count="n/a")]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "id int, value string")
    existing = spark.createDataFrame([("http://x/3",)], "data_url string")
    res = tolerant_write(df, key=("data_url",), keep=("id",), existing_keys=existing)
    reasons = {r["id"]: r["reason"] for r in res.flagged.collect()}
    assert reasons[2] is None
    assert sorted([reasons[0], reasons[1]], key=str) == ["duplicate key", None] or \
        sorted([reasons[0], reasons[1]], key=lambda x: x or "") == [None, "duplicate key"]
    assert reasons[3] == "key exists" and reasons[4] == "arity" and reasons[5] == "type:band_count"
    assert res.accepted.count() + res.rejected.count() == len(lines)
    assert res.accepted.columns == ["id", *STORED_COLUMNS]


def test_tolerant_write_duplicate_choice_is_deterministic(spark):
    lines = [(i, _line(image_id=f"img{i % 3}")) for i in range(30)]
    df = spark.createDataFrame(lines, "id int, value string")
    a = sorted(r["id"] for r in tolerant_write(df.repartition(1), key=("image_id",), keep=("id",)).accepted.collect())
    b = sorted(r["id"] for r in tolerant_write(df.repartition(9), key=("image_id",), keep=("id",)).accepted.collect())
    assert a == b and len(a) == 3


def test_jdbc_frame_positional_order(spark):
    df = spark.createDataFrame([(GOOD,)], "value string")
    res = tolerant_write(df)
    assert jdbc_frame(res.accepted).columns == list(STORED_COLUMNS)


def test_frame_sink_round_trip_and_pruning(spark):
    obs = X.observations(X.reader(spark, "/root/testdata/sf0.001"))
    binary = mineral_map(obs, order=("acq", "l_orderkey", "scene")).binary
    path = os.path.join(tempfile.mkdtemp(prefix="frames-"), "out")
    frame_sink(binary, path)
    back = read_frames(spark, path)
    cols = ["gx", "gy", "frame_row", "frame_col", "v", "bit"]
    assert sorted(map(tuple, back.select(*cols).collect())) == sorted(map(tuple, binary.select(*cols).collect()))
    one = read_frames(spark, path, frame_row=0, frame_col=0)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(frame_row" in plan


def test_frames_are_listed_by_one_job(spark, tmp_path):
    """rows of many frames were listed by a job each."""
    cells = spark.range(3 * 33).select((F.col("id") % 33).cast("int").alias("gx"), F.lit(0).alias("gy"), F.lit(0).alias("cell_row"),
                                       F.lit(0).alias("cell_col"), F.col("id").cast("double").alias("v"),
                                       F.floor(F.col("id") / 33).cast("int").alias("frame_row"), (F.col("id") % 33).cast("int").alias("frame_col"))
    path = str(tmp_path / "frames")
    frame_sink(cells, path)
    sc = spark.sparkContext
    sc.setJobGroup("list-frames", "list-frames")
    try:
        back = read_frames(spark, path)
        jobs = sc.statusTracker().getJobIdsForGroup("list-frames")
    finally:
        sc.setJobGroup("", "")
    assert len(jobs) <= 2, jobs  # the listing and the schema
    assert sorted(map(tuple, back.select("frame_row", "frame_col", "v").collect())) == [(i // 33, i % 33, float(i)) for i in range(99)]


def _some_frames(spark, rows, cols):
    return spark.range(rows * cols * 3).select(
        F.col("id").cast("int").alias("gx"), F.lit(0).alias("gy"), F.lit(0).alias("cell_row"), (F.col("id") % 3).cast("int").alias("cell_col"),
        F.col("id").cast("double").alias("v"), F.floor(F.col("id") / (3 * cols)).cast("int").alias("frame_row"),
        (F.floor(F.col("id") / 3) % cols).cast("int").alias("frame_col"))


def test_many_rows_of_frames_are_listed_by_few_tasks(spark, tmp_path):
    """a task was started for each frame to list its folder."""
    path = str(tmp_path / "frames")
    cells = _some_frames(spark, 40, 5)
    frame_sink(cells, path)
    sc = spark.sparkContext
    sc.setJobGroup("list-rows", "list-rows")
    try:
        back = read_frames(spark, path)
        tracker = sc.statusTracker()
        jobs = tracker.getJobIdsForGroup("list-rows")
    finally:
        sc.setJobGroup("", "")
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds]
    assert len(jobs) <= 2 and sum(tasks) <= 41, tasks
    assert sorted(map(tuple, back.select(*cells.columns).collect())) == sorted(map(tuple, cells.collect()))


def test_frames_are_whole_files_with_checked_pages_and_no_side_files(spark, tmp_path):
    """a .crc beside each local file cost three more processes a file; pages are checked instead."""
    path = tmp_path / "frames"
    frame_sink(_some_frames(spark, 2, 20), str(path))
    files = sorted(path.glob("*/*/*.parquet"))
    assert len(files) == 40 and not list(path.rglob("*.crc"))
    data = bytearray(files[7].read_bytes())
    column = pq.ParquetFile(files[7]).metadata.row_group(0).column(0)
    at = (column.dictionary_page_offset or column.data_page_offset) + column.total_compressed_size - 1  # in its last page
    data[at] ^= 255
    files[7].write_bytes(data)
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_frames(spark, str(path)).agg(F.sum("v"), F.sum("gx"), F.sum("cell_col")).collect()


@pytest.mark.parametrize("how", ["checkpoint", "parquet", "persist"])
def test_materialise(spark, how):
    df = spark.range(100).withColumn("y", F.col("id") * 2)
    m = materialise(df, how)
    assert m.agg(F.sum("y")).first()[0] == 9900


def test_write_catalog_stages_then_reaches_jdbc(spark):
    """Everything up to the database connection runs; no database exists here,
    so the append fails for want of a driver -- after the rejects are kept."""
    from lodestar.sinks.jdbc import write_catalog
    lines = [GOOD, "a,b", _line(band_count="n/a")]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    rejects = os.path.join(tempfile.mkdtemp(prefix="rejects-"), "r")
    with pytest.raises(Exception) as err:
        write_catalog(df, "jdbc:nosuchdb://nowhere/x", "raster_catalog", rejects, key=("data_url",),
                      batchsize=500, max_connections=4)
    assert "driver" in str(err.value).lower()
    got = sorted(r["reason"] for r in spark.read.parquet(rejects).collect())
    assert got == ["arity", "type:band_count"]


def test_hot_duplicate_key_keeps_exactly_one(spark):
    """A third of all lines share one key: one is stored, the rest are duplicates."""
    n = 300
    lines = [(i, _line(data_url="http://x/hot" if i % 3 == 0 else f"http://x/{i}", image_id=f"img{i}"))
             for i in range(n)]
    df = spark.createDataFrame(lines, "id int, value string").repartition(7)
    res = tolerant_write(df, key=("data_url",), keep=("id",))
    flagged = res.flagged.collect()
    hot = [r for r in flagged if r["data_url"] == "http://x/hot" or (r["reason"] == "duplicate key")]
    assert sum(1 for r in hot if r["reason"] is None) == 1
    assert sum(1 for r in flagged if r["reason"] == "duplicate key") == n // 3 - 1
    assert res.accepted.count() == n - (n // 3 - 1)


def _keyed_line(i, url):
    return f"S,{url},L1,x,15m,u,{i},img,p,name,3,VNIR,b,1.5"


def test_identical_lines_leave_one_survivor(spark):
    from lodestar.sinks.jdbc import tolerant_write
    lines = [_keyed_line(1, "a")] * 3 + [_keyed_line(2, "b"), _keyed_line(3, "b"), _keyed_line(4, "c"), "short,line"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    stored = spark.createDataFrame([("c",), ("zzz",)], "data_url string")
    res = tolerant_write(df, key=("data_url",), existing_keys=stored)
    assert sorted(r["data_url"] for r in res.accepted.collect()) == ["a", "b"]
    assert sorted(r["reason"] for r in res.rejected.collect()) == ["arity", "duplicate key", "duplicate key",
                                                                   "duplicate key", "key exists"]
    kept = tolerant_write(df, key=("timestamp",), on_error="keep")
    assert kept.accepted.count() == 5  # 1, 2, 3, 4 and the failed record's default


def test_hot_key_and_failed_lines_are_split_over_tasks(spark):
    from lodestar.sinks.jdbc import tolerant_write
    old = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
    try:
        i = F.col("id")
        df = spark.range(0, 60_000, 1, 16).select(F.when(i % 3 == 0, F.lit("bad line")).otherwise(F.format_string(
            "S,%s,L1,x,15m,u,%d,img,p,name,3,VNIR,b,1.5",
            F.when(i % 3 == 1, F.lit("hot")).otherwise(i.cast("string")), i)).alias("value"))
        res = tolerant_write(df, key=("data_url",))
        rows = res.flagged.groupBy("reason").count()
        assert {r["reason"]: r["count"] for r in rows.collect()} == {
            "arity": 20_000, "duplicate key": 19_999, None: 20_001}
        flagged = res.flagged.select("reason", "line")
        flagged.collect()
        assert "skew=true" in flagged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_scene_files_are_listed(spark, tmp_path):
    for name in ("b.hdf", "a.hdf", "c.HDF", "d.hdf.txt"):
        (tmp_path / name).write_text("")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.hdf").write_text("x")
    assert sorted(r["name"] for r in scene_listing(spark, str(tmp_path)).collect()) == ["a.hdf", "b.hdf"]
