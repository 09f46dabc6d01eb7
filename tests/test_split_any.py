"""The linear split for regular-expression separators against the look-ahead form."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lodestar.functions.strings import QUOTE_AWARE_LOOKAHEAD, _cuts_within_segments, quoted_split

LINEAR = [r"\|", "::", ";", r"\s*;\s*", "[;|]", r"(?:;|\|)+", "a{2,3}", "[a-c]+", r"\t", r"\\", r"\.", r"(;|:):?", r"\d+", "(a|ab)", r"\s+", ";+?", ";++"]
OTHERS = [",*", "^;", ";$", ".", r"\W", "[^a]", '"', r"\b;", "(?=;)", r"(;)\1", "[!-a]", r"\s*", "(?<!a);", r"\S", r"\D", "a|ab", ";|:"]


@pytest.mark.parametrize("separator", LINEAR)
def test_equals_the_look_ahead(spark, separator):
    assert _cuts_within_segments(separator) or len(separator) == 1
    rng = random.Random(separator)
    lines = ["".join(rng.choice(';;|::.aabc12 \t\\""\x00\x01\x02é') for _ in range(rng.randint(0, 40))) for _ in range(400)] + ["", '"', None]
    df = spark.createDataFrame([(s,) for s in lines], "l string")
    plain = F.split("l", separator + QUOTE_AWARE_LOOKAHEAD, -1)
    bad = df.select("l", quoted_split("l", separator).alias("a"), plain.alias("b")).filter(~F.col("a").eqNullSafe(F.col("b")))
    assert bad.collect() == []


@pytest.mark.parametrize("separator", OTHERS)
def test_separators_that_look_further_keep_the_look_ahead(spark, separator):
    assert not _cuts_within_segments(separator)
    df = spark.createDataFrame([('a;b,"c;d",;x',)], "l string")
    a, b = df.select(quoted_split("l", separator), F.split("l", separator + QUOTE_AWARE_LOOKAHEAD, -1)).first()
    assert a == b


@pytest.mark.parametrize("separator", [r"\|", "::"])
def test_long_quoted_polygons_take_linear_time(spark, separator):
    text = separator.replace("\\", "")
    line = text.join(f"{i}" for i in range(20_000)) + text + '"' + text.join("1 2" for _ in range(40_000)) + '"'
    df = spark.createDataFrame([(line,)] * 4, "l string").repartition(1)
    start = time.time()
    assert [r[0] for r in df.select(F.size(quoted_split("l", separator))).collect()] == [20_001] * 4
    assert time.time() - start < 20
