"""Every registered query with SQL gives DuckDB's result on the smallest tables; every other one runs."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return str(round(v, 6)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cur = duck.execute(SQL[name])
    found = [d[0] for d in cur.description]
    assert sorted(found) == columns
    at = [found.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
