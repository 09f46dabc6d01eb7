"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from lodestar.plans.oracle import ORACLE
from lodestar.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else round(v, 6)
        return v
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_entry_registers_the_engine():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
