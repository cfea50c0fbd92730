"""Every registered query against its DuckDB oracle on the smallest data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from oracle_check import TABLES
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _names():
    from squall.plans import queries
    return sorted(queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import same_rows
    from squall.plans import oracle_sql, queries
    sdf = queries()[name](spark, SF).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(sdf) >= 0
        return
    odf = duck.execute(sql).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    ok, diff = same_rows(sdf, odf)
    assert ok, diff


def test_entry_smoke(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())
