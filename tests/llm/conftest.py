import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text[, source]) tuples."""
    def make(rows, extra=""):
        rows = [(*r, "s") if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, source string" + extra).repartition(3)
    return make


@pytest.fixture(scope="session")
def duck():
    import duckdb
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def real_rows(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()
