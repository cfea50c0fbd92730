"""Queries that SQL can express against their DuckDB form."""

import pytest

from squall.llm import queries as corpus

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(corpus.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    from oracle_check import same_rows
    got = corpus.queries()[name](spark, SF).toPandas()
    want = duck.execute(corpus.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    # one pandas form for whole numbers with nulls
    got = got.astype({c: t for c, t in want.dtypes.items() if str(t) == "Int64"})
    ok, diff = same_rows(got, want)
    assert ok, diff


def test_names_cover_the_operators():
    assert [n.split("_")[0] for n in corpus.queries()] == [f"op{i}" for i in range(1, 14)]
