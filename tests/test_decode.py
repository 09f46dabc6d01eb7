"""Typed decode: numeric grammar, booleans, chars, error gating and policies."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions import decode as D
from lodestar.plans.catalog import load_catalog
from lodestar.schema import CATALOG_SCHEMA

GOOD = '"SAT,O",http://x/1,L1,1-URGENT,15m,http://x/i/1,1000,img5,p,name,3,VNIR,"5 1,6 1",7'


def _line(**over):
    parts = ['"SAT,O"', "http://x/1", "L1", "1-URGENT", "15m", "http://x/i/1", "1000", "img5",
             "p", "name", "3", "VNIR", '"5 1,6 1"', "7"]
    names = [f.name for f in CATALOG_SCHEMA.fields]
    for k, v in over.items():
        parts[names.index(k)] = v
    return ",".join(parts)


def _decode(spark, lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "id int, value string")
    return {r["id"]: r for r in D.decode_lines(df, keep=("id",)).collect()}


def _parse(spark, values, dtype):
    field = T.StructField("f", dtype)
    df = spark.createDataFrame([(v,) for v in values], "s string")
    v, ok, _ = D.parse_field(F.col("s"), field)
    return [r[0] for r in df.select(v).collect()]


def test_good_line(spark):
    r = _decode(spark, [GOOD])[0]
    assert r["satellite"] == '"SAT,O"' and r["boundary"] == '"5 1,6 1"'
    assert r["timestamp"] == 1000 and r["band_count"] == 3 and r["cloud"] == 7.0
    assert r["error"] is None and r["error_field"] is None


def test_integer_grammar(spark):
    got = _parse(spark, ["", None, "+5", "-0", " 5", "5.0", "9999999999", "1e3", "0x10", "٣"], T.IntegerType())
    assert got == [0, 0, 5, 0, None, None, None, None, None, None]
    assert _parse(spark, ["9999999999", "-9223372036854775808", "9223372036854775808"], T.LongType()) == \
        [9999999999, -9223372036854775808, None]


def test_double_grammar(spark):
    got = _parse(spark, ["", "1e3", ".5", "5.", " 5 ", "1d", "2.5F", "NaN", "-Infinity", "+NaN",
                         "inf", "nan", ".", "1e", "0x1p3", " "], T.DoubleType())
    assert got[:7] == [0.0, 1000.0, 0.5, 5.0, 5.0, 1.0, 2.5]
    assert got[7] != got[7] and got[8] == float("-inf") and got[9] != got[9]
    assert got[10:] == [None, None, None, None, None, None]


def test_boolean_and_char(spark):
    df = spark.createDataFrame([(v,) for v in ["true", "TRUE", "TrUe", "t", "yes", "1", "", None]], "s string")
    assert [r[0] for r in df.select(D.boolean_decode("s")).collect()] == [True, True, True] + [False] * 5
    df = spark.createDataFrame([(v,) for v in ["abc", "", None]], "s string")
    assert [r[0] for r in df.select(D.char_decode("s")).collect()] == ["a", " ", " "]


def test_arity_error_defaults_everything(spark):
    r = _decode(spark, [GOOD.rsplit(",", 1)[0]])[0]  # 13 fields
    assert r["error"] == "arity" and r["error_field"] is None
    assert r["satellite"] is None and r["timestamp"] == 0 and r["band_count"] == 0 and r["cloud"] == 0.0


@pytest.mark.parametrize("field,bad,before_kept", [
    ("timestamp", "x1", ["satellite", "image_url"]),
    ("band_count", "n/a", ["satellite", "timestamp", "name_en"]),
    ("cloud", "cloudy", ["satellite", "timestamp", "band_count", "boundary"]),
])
def test_first_bad_number_stops_assignment(spark, field, bad, before_kept):
    r = _decode(spark, [_line(**{field: bad})])[0]
    good = _decode(spark, [GOOD])[0]
    assert r["error"] == "type" and r["error_field"] == field
    for f in before_kept:
        assert r[f] == good[f]
    names = [f.name for f in CATALOG_SCHEMA.fields]
    for f in names[names.index(field):]:
        assert r[f] in (None, 0, 0.0)


def test_empty_numbers_read_as_zero(spark):
    r = _decode(spark, [_line(timestamp="", band_count="", cloud="")])[0]
    assert r["error"] is None and r["timestamp"] == 0 and r["band_count"] == 0 and r["cloud"] == 0.0


def test_error_policies(spark):
    lines = [GOOD, GOOD.rsplit(",", 1)[0], _line(cloud="bad")]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    keep = load_catalog(df, on_error="keep")
    assert keep.stored.count() == 3 and keep.rejected is None
    q = load_catalog(df, on_error="quarantine")
    assert q.stored.count() == 1
    assert sorted(r["error"] for r in q.rejected.collect()) == ["arity", "type"]
    assert load_catalog(df, on_error="drop").stored.count() == 1
    rep = q.report.first()
    assert (rep["attempted"], rep["rejected"], rep["accepted"]) == (3, 2, 1)
    with pytest.raises(PySparkException):
        load_catalog(df, on_error="fail").stored.collect()
    assert load_catalog(df.limit(1), on_error="fail").stored.count() == 1


def test_stored_row_has_constants_in_order(spark):
    df = spark.createDataFrame([(GOOD,)], "value string")
    st = load_catalog(df).stored
    assert st.columns[-3:] == ["owner", "privilege", "has_data"]
    r = st.first()
    assert (r["owner"], r["privilege"], r["has_data"]) == ("ADMIN", "PUBLIC", False)


def test_encode_then_decode_round_trip(spark):
    """decode(encode(r)) == r for records whose strings carry no unquoted commas."""
    df = spark.createDataFrame([(GOOD,), (_line(timestamp="-7", band_count="0", cloud="2.5"),)], "value string")
    dec = D.apply_error_policy(D.decode_lines(df), "keep")
    names = [f.name for f in CATALOG_SCHEMA.fields]
    enc = dec.select(D.record_encode(names).alias("value"))
    again = D.apply_error_policy(D.decode_lines(enc), "keep")
    assert sorted(map(tuple, dec.collect())) == sorted(map(tuple, again.collect()))


def test_encode_prints_null(spark):
    df = spark.createDataFrame([("a", None, 1)], "a string, b string, c int")
    assert df.select(D.record_encode(["a", "b", "c"])).first()[0] == "a,null,1"


def test_long_quoted_polygon_decodes_whole_and_fast(spark):
    """A boundary of 2,000 vertices: commas inside the quotes stay in the value,
    and the split is linear (the look-ahead regex took minutes on such lines)."""
    import time
    poly = '"' + ",".join(f"{i} {i + 1}" for i in range(2000)) + '"'
    lines = [_line(boundary=poly, image_id=f"img{i}") for i in range(300)]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "id int, value string")
    t = time.perf_counter()
    rows = D.decode_lines(df, keep=("id",)).select("error", "boundary", "cloud").collect()
    assert time.perf_counter() - t < 60
    assert all(r["error"] is None and r["boundary"] == poly and r["cloud"] == 7.0 for r in rows)


def test_many_quotes_split_fast_and_exact(spark):
    """Thousands of quotes in one field: the linear split stays linear (no
    per-segment re-split) and equals the look-ahead definition."""
    import re
    import time
    from lodestar.functions.strings import QUOTE_AWARE_LOOKAHEAD, quoted_split
    inner = ",".join(f'""p{i}""' for i in range(1000))
    lines = [f'a{i},"{inner}",z' for i in range(40)]
    df = spark.createDataFrame([(l,) for l in lines], "l string")
    t = time.perf_counter()
    got = [r[0] for r in df.select(quoted_split("l")).collect()]
    assert time.perf_counter() - t < 60
    assert got == [re.split("," + QUOTE_AWARE_LOOKAHEAD, l) for l in lines]
    assert all(len(p) == 3 for p in got)
