"""Line dedup keeps lines that differ in their numbers."""

import corpus_pipeline as P

from squall.llm.line_spread import line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_lines_of_other_numbers_are_other_lines(docs_of):
    rows = [(i, f"Chapter {i}\n{12 + i}.50 | 30\nAll  rights reserved 2020", f"s{i}") for i in range(15)]
    got = {r["doc_id"]: r for r in line_dedup(docs_of(rows)).collect()}
    assert got[0]["kept_text"] == rows[0][1]
    assert all(got[i]["kept_text"] == f"Chapter {i}\n{12 + i}.50 | 30" for i in range(1, 15))


def test_keys_lose_blanks_and_nothing_else(docs_of):
    rows = [(i, f"0 of  10\n12{i + 10}1\n\tA Notice  ", f"s{i}") for i in range(15)]
    for fold in (False, True):
        got = {r["doc_id"]: r["kept_text"] for r in line_dedup(docs_of(rows), fold_digits=fold).collect()}
        assert got[0] == rows[0][1]
        assert all(got[i] == ("" if fold else f"12{i + 10}1") for i in range(1, 15))


def test_pipeline_keeps_documents_of_numbers(spark):
    rows = [(i, f"{1990 + i}\nTotal: {4512 + i}\nthe same {2020} notice", "en", f"s{i}", 40) for i in range(20)]
    rows += [(100 + i, f"{30 + i}", "en", f"s{i}", 2) for i in range(20)]
    got = {r["doc_id"]: r["text"] for r in P.lines(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert set(got) == {r[0] for r in rows}
    assert got[0] == rows[0][1] and got[5] == "1995\nTotal: 4517" and got[105] == "35"
