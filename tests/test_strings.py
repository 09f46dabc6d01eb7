"""Split and small string helpers on literal edge cases."""

import pytest
from pyspark.sql import functions as F

from lodestar.functions import strings as S


@pytest.fixture(scope="module")
def lit_df(spark):
    def make(values):
        return spark.createDataFrame([(v,) for v in values], "s string")
    return make


def _apply(lit_df, values, fn):
    return [r[0] for r in lit_df(values).select(fn(F.col("s"))).collect()]


def test_quoted_split_edge_cases(lit_df):
    got = _apply(lit_df, ['a,"b,c",d,', 'a,"b,c,d', "", ",,", 'a,""x"",b'], S.quoted_split)
    assert got[0] == ["a", '"b,c"', "d", ""]
    # an unbalanced quote: commas before it see an odd count and do not split
    assert got[1] == ['a,"b', "c", "d"]
    assert got[2] == [""]
    assert got[3] == ["", "", ""]
    assert got[4] == ["a", '""x""', "b"]


def test_quoted_split_nonempty_trims_java_style(lit_df):
    got = _apply(lit_df, [" a ,\t, ,b", "\x01x\x1f,y"], S.quoted_split_nonempty)
    assert got[0] == ["a", "b"]
    assert got[1] == ["x", "y"]


def test_has_length(lit_df):
    assert _apply(lit_df, ["a", "", None, " "], S.has_length) == [True, False, False, True]


def test_trim_end_and_head(lit_df):
    assert _apply(lit_df, ["a.tif", "a.tif.tif", "tif", None], lambda c: S.trim_end(c, ".tif")) == \
        ["a", "a.tif", "tif", None]
    assert _apply(lit_df, ["http://x", "http://", "xhttp://"], lambda c: S.trim_head(c, "http://")) == \
        ["x", "", "xhttp://"]


def test_trim_quotechar(lit_df):
    assert _apply(lit_df, ['"a"', '"', '""', 'a"', '"a,b"'], S.trim_quotechar) == ["a", '"', "", 'a"', "a,b"]


def test_output_path_replaces_every_occurrence(lit_df):
    got = _apply(lit_df, ["a.hdf", "a.hdf.hdf", "A.HDF"], lambda c: S.output_path(c, "/out/"))
    assert got == ["/out/a.tif", "/out/a.tif.tif", "/out/A.HDF"]


def test_token_list_keeps_last_token(lit_df):
    got = _apply(lit_df, ["x.TIF y.tif z.TIF\n", "a.TIF  b.TIF", "", "n.TIFF"], S.token_list)
    assert got == [["x.TIF", "z.TIF"], ["a.TIF", "b.TIF"], [], []]


def test_suffix_filter_is_case_sensitive(lit_df):
    assert _apply(lit_df, ["a.hdf", "a.HDF", None, "hdf"], lambda c: S.suffix_filter(c, ".hdf")) == \
        [True, False, False, False]
