"""The command line runs the same plans (in-process, reusing the test session)."""

import json
import os
import tempfile

from lodestar.__main__ import main
from lodestar.plans import fixtures as X


def test_cli_map_and_list(spark, capsys):
    root = tempfile.mkdtemp(prefix="cli-")
    pixels = os.path.join(root, "pixels")
    X.observations(X.reader(spark, "/root/testdata/sf0.001")).write.parquet(pixels)
    out = os.path.join(root, "frames")
    assert main(["map", pixels, "--out", out, "--order", "acq,l_orderkey,scene"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["frames"] >= 1 and os.path.isdir(out)
    for name in ("x.hdf", "y.HDF"):
        with open(os.path.join(root, name), "w") as fh:
            fh.write("scene")
    assert main(["list-scenes", root]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert lines[-2] == "x.hdf" and json.loads(lines[-1]) == {"scenes": 1}


def test_cli_load_catalog_reaches_jdbc(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="cli-load-")
    src = os.path.join(root, "lines")
    X.catalog_lines(X.reader(spark, "/root/testdata/sf0.001")).select("line").write.text(src)
    rejects = os.path.join(root, "rejects")
    with pytest.raises(Exception) as err:
        main(["load-catalog", src, "--url", "jdbc:nosuchdb://nowhere/x", "--table", "raster_catalog",
              "--rejects", rejects, "--key", "data_url", "--max-connections", "2"])
    assert "driver" in str(err.value).lower()
    assert spark.read.parquet(rejects).count() > 0   # rejects kept before the database step
