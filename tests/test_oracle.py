"""Every query of the engine beside its SQL in DuckDB, on the smallest tables."""

import glob

import duckdb
import pytest

from lodeframe.plans import case_queries, check_queries, feed_queries, io_queries  # noqa: F401
from lodeframe.plans import queries as Q
from verify import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {p.split('/')[-1][:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", Q.QUERIES)
def test_query(spark, con, name):
    df = Q.QUERIES[name](spark, SF)
    mine = rows_of(df.columns, df.collect())
    if name in Q.ORACLE:
        rel = con.sql(Q.ORACLE[name])
        assert sorted(rel.columns) == sorted(df.columns)
        assert mine == rows_of(rel.columns, rel.fetchall())
