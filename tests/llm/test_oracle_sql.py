import math

import duckdb
import pytest

from lodestar.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    want = sorted(want.fetchall())
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    got = sorted(tuple(r) for r in df.select(*columns).collect())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12)) for x, y in zip(a, b)), (a, b)
