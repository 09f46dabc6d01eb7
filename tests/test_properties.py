"""Property tests: Spark column functions against plain-Python definitions
on random inputs (each hypothesis example is one batch, one Spark job)."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions import decode as D
from lodestar.functions import strings as S
from lodestar.schema import CATALOG_SCHEMA

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
texts = st.lists(st.text(alphabet='ab,"\t \x01\x00', max_size=24), min_size=1, max_size=150)
CTRL = "".join(chr(i) for i in range(0x21))


def _py_split(s):
    return re.split("," + S.QUOTE_AWARE_LOOKAHEAD, s)


def _run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in sorted(df.select("i", fn(F.col("s"))).collect())]


@SETTINGS
@given(values=texts)
def test_split_matches_python_regex(spark, values):
    assert _run(spark, values, S.quoted_split) == [_py_split(v) for v in values]


@SETTINGS
@given(values=st.lists(st.text(alphabet='ab;"|', max_size=24), min_size=1, max_size=100))
def test_split_other_separators(spark, values):
    for sep in (";", "\\|"):
        want = [re.split(sep + S.QUOTE_AWARE_LOOKAHEAD, v) for v in values]
        assert _run(spark, values, lambda c: S.quoted_split(c, sep)) == want


@SETTINGS
@given(values=texts)
def test_split_nonempty_matches_definition(spark, values):
    want = [[t for t in (p.strip(CTRL) for p in _py_split(v)) if t] for v in values]
    assert _run(spark, values, S.quoted_split_nonempty) == want


@SETTINGS
@given(values=st.lists(st.text(alphabet='ab."', max_size=8), min_size=1, max_size=100))
def test_trims_match_definition(spark, values):
    assert _run(spark, values, lambda c: S.trim_end(c, ".a")) == \
        [v[:-2] if v.endswith(".a") else v for v in values]
    assert _run(spark, values, lambda c: S.trim_head(c, "a.")) == \
        [v[2:] if v.startswith("a.") else v for v in values]
    assert _run(spark, values, S.trim_quotechar) == \
        [v[1:-1] if len(v) >= 2 and v[0] == '"' and v[-1] == '"' else v for v in values]


words = st.text(alphabet="abcXYZ019 _-./:", min_size=0, max_size=10).filter(lambda s: s != "null")
doubles = st.floats(allow_nan=False, allow_infinity=True, width=64)
records = st.tuples(*[
    (st.integers(-2**63, 2**63 - 1) if isinstance(f.dataType, T.LongType)
     else st.integers(-2**31, 2**31 - 1) if isinstance(f.dataType, T.IntegerType)
     else doubles if isinstance(f.dataType, T.DoubleType)
     else words)
    for f in CATALOG_SCHEMA.fields])


@SETTINGS
@given(rows=st.lists(records, min_size=1, max_size=100))
def test_decode_inverts_encode(spark, rows):
    names = [f.name for f in CATALOG_SCHEMA.fields]
    df = spark.createDataFrame(rows, CATALOG_SCHEMA)
    enc = df.select(D.record_encode(names).alias("value"))
    back = D.apply_error_policy(D.decode_lines(enc), "keep").collect()
    assert sorted(map(tuple, back), key=repr) == sorted(rows, key=repr)
    assert all(not (isinstance(x, float) and math.isnan(x)) for r in back for x in r)


@SETTINGS
@given(pts=st.lists(st.tuples(st.floats(0, 3), st.floats(-75, 75)), min_size=1, max_size=100))
def test_projection_is_symmetric_about_the_central_meridian(spark, pts):
    from lodestar.functions.raster import project_utm
    rows = [(45.0 + d, lat, 45.0 - d) for d, lat in pts]
    df = spark.createDataFrame(rows, "lon_e double, lat double, lon_w double")
    ee, ne = project_utm("lon_e", "lat")
    ew, nw = project_utm("lon_w", "lat")
    c, _ = project_utm(F.lit(45.0), "lat")
    for r in df.select(ee.alias("ee"), ne.alias("ne"), ew.alias("ew"), nw.alias("nw"), c.alias("c")).collect():
        assert abs((r["ee"] - 500000.0) + (r["ew"] - 500000.0)) < 1e-6
        assert abs(r["ne"] - r["nw"]) < 1e-6
        assert abs(r["c"] - 500000.0) < 1e-9
