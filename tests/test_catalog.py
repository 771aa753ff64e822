"""Every catalogue query against its SQL twin in DuckDB, and shuffle invariance of the flagship."""

import glob
import os

import duckdb
import pytest

from paragrid.plans import catalog, corpus, runs  # noqa: F401  corpus and runs add their queries


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def canon(frame):
    cell = lambda x: "NULL" if x is None or x != x else f"{x:.5f}" if isinstance(x, float) else str(x)
    return sorted(tuple(cell(x) for x in row) for row in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, small, oracle, name):
    got = catalog.QUERIES[name](spark, small).toPandas()
    if name not in catalog.ORACLE_SQL:
        assert len(got)
        return
    want = oracle.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


def test_entry(spark, small):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
