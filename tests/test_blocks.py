"""Frame blocks: packing and unpacking, bitmaps, gaps, and cells that don't belong."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestar.operators.blocks import n_words, pack_blocks, unpack_blocks
from lodestar.operators.grid import GridSpec
from lodestar.operators.mosaic import dense_cells
from lodestar.sinks.frames import block_sink, read_blocks

SPEC = GridSpec(res=10.0, width=13, height=11)  # 143 cells: two whole words and a part of a third
CELLS = "frame_row int, frame_col int, cell_row int, cell_col int, v double, bit int"


def frames_of(spark, n):
    return spark.createDataFrame([(r, c) for r in range(n) for c in range(2)], "frame_row int, frame_col int")


def some_cells(seed=0):
    rng = random.Random(seed)
    out = []
    for r, c, share in ((0, 0, 1.0), (0, 1, 0.3), (1, 0, 0.02)):  # full, scattered, nearly empty; the others blank
        for at in range(SPEC.width * SPEC.height):
            if rng.random() < share or at in ((63, 64, 142) if share < 1 else ()):
                v = round(rng.uniform(-1, 1), 3)
                out.append((r, c, at // SPEC.width, at % SPEC.width, v, int(v >= 0.3)))
    return out


def test_cells_come_back_as_they_went_in(spark):
    cells = some_cells()
    blocks = pack_blocks(spark.createDataFrame(cells, CELLS), frames_of(spark, 3), SPEC)
    rows = {(r.frame_row, r.frame_col): r for r in blocks.collect()}
    assert len(rows) == 6
    for (fr, fc), r in rows.items():
        mine = sorted((a * SPEC.width + b, v, bit) for i, j, a, b, v, bit in cells if (i, j) == (fr, fc))
        assert r.n_valid == len(mine) == len(r.v) and r.v == [v for _, v, _ in mine]
        assert len(r.valid) == len(r.hot) == len(r.starts) == n_words(SPEC) == 3
        for k in range(3):
            here = [(a - 64 * k, bit) for a, _, bit in mine if a // 64 == k]
            assert r.valid[k] % 2**64 == sum(1 << a for a, _ in here)
            assert r.hot[k] % 2**64 == sum(1 << a for a, bit in here if bit)
            assert r.starts[k] == sum(a < 64 * k for a, _, _ in mine)
    back = sorted(tuple(r) for r in unpack_blocks(blocks, SPEC, dense=False).collect())
    assert back == sorted(cells)


def test_dense_cells_list_every_cell_once(spark):
    cells = some_cells(1)
    dense = dense_cells(spark.createDataFrame(cells, CELLS), frames_of(spark, 3), SPEC)
    rows = [tuple(r) for r in dense.collect()]
    held = {(r, c, a, b): (v, bit) for r, c, a, b, v, bit in cells}
    assert len(rows) == 6 * 143 == len({r[:4] for r in rows})
    assert all(r[4:] == held.get(r[:4], (None, None)) for r in rows)
    assert "Python" not in dense._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in dense._jdf.queryExecution().executedPlan().toString()


def test_null_values_are_blank_and_no_cells_give_blank_frames(spark):
    none = spark.createDataFrame([(0, 0, 1, 1, None, None)], CELLS)
    (r, *rest) = pack_blocks(none, frames_of(spark, 1), SPEC).orderBy("frame_col").collect()
    assert r.n_valid == 0 and r.valid == [0, 0, 0] and r.starts == [0, 0, 0] and r.v == []
    assert unpack_blocks(pack_blocks(none.where("false"), frames_of(spark, 1), SPEC), SPEC).count() == 2 * 143


def test_a_cell_of_an_unknown_frame_is_named(spark):
    lost = spark.createDataFrame([(0, 0, 1, 1, 0.5, 1), (7, 9, 0, 0, 0.5, 1)], CELLS)
    with pytest.raises(Exception, match="r7_c9"):
        dense_cells(lost, frames_of(spark, 1), SPEC).collect()


def test_a_cell_outside_its_frame_fails(spark):
    wrong = spark.createDataFrame([(0, 0, 11, 0, 0.5, 1)], CELLS)
    with pytest.raises(Exception, match="cell outside its frame"):
        pack_blocks(wrong, frames_of(spark, 1), SPEC).collect()


def test_a_hot_frame_is_aggregated_before_it_meets(spark):
    df = pack_blocks(spark.range(10).select(F.lit(0).alias("frame_row"), F.lit(0).alias("frame_col"), F.lit(0).alias("cell_row"),
                                            F.col("id").cast("int").alias("cell_col"), F.lit(0.1).alias("v"), F.lit(0).alias("bit")),
                     frames_of(spark, 1), SPEC)
    assert df.orderBy("frame_col").first().n_valid == 10


def test_cells_are_unpacked_by_generated_code(spark):
    """A lambda lists a frame's words, none looks at single cells (F5)."""
    dense = dense_cells(spark.createDataFrame(some_cells(3), CELLS), frames_of(spark, 2), SPEC)
    assert dense.count() == 4 * 143
    rows = dense.select("frame_row", "frame_col", "cell_row", "cell_col", "v", "bit")
    rows.collect()
    final = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    lists = [line for line in final.splitlines() if " Generate " in line]
    assert re.search(r"\*\(\d+\) Generate explode\(", lists[0]) and "lambda" not in lists[0], lists


def test_blank_blocks_are_stored_without_bitmaps(spark, tmp_path):
    """the zeros of blank frames are not written; reading restores every block."""
    blocks = pack_blocks(spark.createDataFrame(some_cells(4), CELLS), frames_of(spark, 3), SPEC)
    path = str(tmp_path / "blocks")
    block_sink(blocks, path)
    stored = {(r.frame_row, r.frame_col): r for r in spark.read.parquet(path).collect()}
    assert len(stored) == 6
    assert all((r.valid is None and r.hot is None and r.starts is None) == (r.n_valid == 0) for r in stored.values())
    assert sorted(map(str, read_blocks(spark, path, SPEC).collect())) == sorted(map(str, blocks.collect()))


def test_stored_blocks_are_dealt_before_their_zeros_return(spark, tmp_path):
    """one task unpacked all frames of a small file, however many blank ones it held."""
    blocks = pack_blocks(spark.createDataFrame(some_cells(5), CELLS), frames_of(spark, 30), SPEC)
    path = str(tmp_path / "blocks")
    block_sink(blocks.coalesce(1), path)
    cells = unpack_blocks(read_blocks(spark, path, SPEC), SPEC)
    filled = cells.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in filled) == 60 * 143 and len(filled) > 1
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "coalesce(" in plan and "coalesce(" not in plan[plan.index("Exchange"):]
