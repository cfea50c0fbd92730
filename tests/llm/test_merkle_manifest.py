"""Merkle manifest against a plain one."""

from brute import merkle_manifest as plain
from pyspark.sql import functions as F

from squall.llm import merkle_manifest as M

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def compare(spark, rows):
    got = M.merkle_manifest(spark.createDataFrame(rows, SCHEMA).repartition(3)).select(*COLUMNS).collect()
    want = plain(rows)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    return got


def test_several_levels_and_one_hot_source(spark):
    rows = [(i, "hot", "en", i, f"Text {i} É") for i in range(300)] + [(1000 + i, f"s{i % 20}", None, None, "aB") for i in range(60)]
    got = compare(spark, rows)
    # a tampered row with capitals fails, all others hold
    assert 0 < sum(not r["verified"] for r in got) < 120
    assert len({r["root"] for r in got}) == 1 and len({r["subroot"] for r in got}) == 21


def test_nulls_repeated_rows_and_ties(spark):
    rows = [(None, None, None, None, None), (None, "", "en", 0, ""), (7, None, "x", 1, "A"), (7, None, "x", 1, "A"),
            (7, None, "y", 1, "b"), (-3, "É", "en", 2, "É"), (5, "z", "en", None, "ABC"), (0, "", None, None, None)]
    rows += [(9, "same", "en", 4, "copy")] * 40
    got = compare(spark, rows)
    assert len(got) == len(rows)


def test_one_run_exactly_and_one_more(spark):
    compare(spark, [(i, "a", "en", 1, "x") for i in range(16)] + [(i, "b", "en", 1, "X") for i in range(17)])


def test_lone_row_is_its_own_root(spark):
    r = compare(spark, [(1, "a", "en", 1, "x")])[0]
    assert r["leaf"] == r["subroot"] == r["root"]


def test_empty_table_long_text_and_other_columns(spark):
    empty = M.merkle_manifest(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[:4] == ["doc_id", "leaf", "subroot", "root"]
    rows = [(1, "a", "en", 1, "Long " * 400_000), (2, "a", "en", 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("mine") for c in ("leaf", "root", "path", "idx", "digest", "g", "run")})
    got = M.merkle_manifest(docs).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows))


def test_no_python_in_the_plan(spark):
    plan = M.merkle_manifest(spark.createDataFrame([(1, "a", "en", 1, "x")], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
