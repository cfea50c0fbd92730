"""Quality rules, line dedup and licence scans on small tables."""

from pyspark.sql import functions as F

from squall.llm.license_digests import KNOWN, known_digests, license_scan
from squall.llm.line_spread import line_dedup
from squall.llm.quality_lines import line_frequency_rules

SCHEMA = "doc_id long, text string, source string"


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def letters(i):
    return "".join(chr(97 + i // 26 ** k % 26) for k in range(4))


def words(a, n):
    """Different words without digits (those are all one to a line key)."""
    return " ".join(f"{a}{letters(i)}" for i in range(n))


def test_repeat_words_counts_first_and_overlaps(docs_of):
    got = by_id(line_frequency_rules(docs_of([
        (1, "a a a a"), (2, "a b c d a b c"), (3, "a b c"), (4, "a b"), (5, "x a b c y a b c a b c")])))
    assert [got[i]["n_repeat_words"] for i in range(1, 6)] == [4, 6, 0, 0, 9]


def test_base_counts(docs_of):
    got = by_id(line_frequency_rules(docs_of([(1, "é# x\n \né# x\n\t\n#$%"), (2, None), (3, "")])))
    r = got[1]
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (5, 9, 5, 1)
    for i in (2, 3):
        assert (got[i]["n_words"], got[i]["n_dup_lines"], got[i]["base_failed"], got[i]["kept"]) == (0, 0, True, False)


def test_frequent_lines_are_per_host_and_deplete(docs_of):
    own = lambda i: words(f"w{letters(i)}q", 60)
    rows = [(i, f"{own(i)}\nShared  LINE {i}", "a") for i in range(4)]
    rows += [(10, f"{own(10)}\nshared line 7", "b"), (11, f"{own(11)}\nshared line 8", None)]
    rows += [(20 + i, words("z", 80), "c") for i in range(4)]
    got = by_id(line_frequency_rules(docs_of(rows), max_docs_per_host=3))
    assert all(got[i]["kept"] and got[i]["n_frequent_lines"] == 1 for i in range(4))
    assert got[0]["clean_text"] == own(0)
    assert got[10]["n_frequent_lines"] == got[11]["n_frequent_lines"] == 0
    # all lines of the copies are frequent on their host: depleted
    assert not any(got[20 + i]["kept"] or got[20 + i]["base_failed"] for i in range(4))


def test_quality_edge_tables(spark, docs_of):
    empty = line_frequency_rules(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and "clean_text" in empty.columns
    same = docs_of([(7, words("a", 60)), (7, words("a", 60)), (None, words("b", 60)), (7, "other")])
    assert line_frequency_rules(same).filter("kept").count() == 3
    clash = docs_of([(1, words("a", 60))]).withColumn("kept", F.lit("mine")).withColumn("key", F.lit(1))
    out = line_frequency_rules(clash).collect()[0]
    assert out["kept"] is True and out["key"] == 1
    long = line_frequency_rules(docs_of([(1, words("a", 30_000))])).collect()[0]
    assert long["n_words"] == 30_000 and long["n_repeat_words"] == 0


def test_line_spread_keeps_first_document(docs_of):
    rows = [(i, f"own {letters(i)}\nAccept 1 cookies", f"s{i}") for i in range(5)]
    rows += [(10 + i, f"local {letters(i)}\nmenu", "s1") for i in range(9)]
    got = by_id(line_dedup(docs_of(rows), min_sites=4))
    assert got[0]["kept_text"] == rows[0][1] and got[0]["n_removed_lines"] == 0
    assert [got[i]["kept_text"] for i in range(1, 5)] == [f"own {letters(i)}" for i in range(1, 5)]
    assert all(got[10 + i]["n_removed_lines"] == 0 for i in range(9))


def test_line_spread_threshold_is_exact(docs_of):
    rows = [(i, "at the limit\nbelow" if i < 5 else "at the limit", f"s{i}") for i in range(6)]
    got = by_id(line_dedup(docs_of(rows), min_sites=6, lg_k=4))
    assert got[0]["n_removed_lines"] == 0
    assert all(got[i]["kept_text"] == ("below" if i < 5 else "") for i in range(1, 6))


def test_line_spread_edges(spark, docs_of):
    assert line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, None), (2, "", None), (3, "x", None), (None, "x", "a"), (4, "x", "b"), (4, "x", "c"), (5, "x", "d")]
    got = line_dedup(docs_of(rows).withColumn("kept_text", F.lit("mine")), min_sites=4).collect()
    assert sorted((str(r["doc_id"]), r["kept_text"]) for r in got) == sorted(
        [("1", ""), ("2", ""), ("3", "x"), ("None", ""), ("4", ""), ("4", ""), ("5", "")])


def test_licence_forms_match(docs_of):
    mit = KNOWN[0][1]
    rows = [(1, mit), (2, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ;")),
            (3, "intro\n\n" + mit + "\n\nmore text"), (4, "Some text.\nlicenced under the Apache Licence, version 2.0\nend"),
            (5, "Released under the MIT License, sort of."), (6, None), (7, ""), (None, "SPDX-License-Identifier: MIT")]
    got = by_id(license_scan(docs_of(rows)))
    assert got[1]["whole_license"] == got[2]["whole_license"] == "MIT"
    assert got[3]["whole_license"] is None and got[3]["licenses"] == []
    assert got[4]["licenses"] == ["Apache-2.0"] and got[4]["n_line_hits"] == 1
    assert all(got[i]["licenses"] == [] for i in (5, 6, 7))
    assert got[None]["whole_license"] == "MIT"


def test_licence_block_inside_a_document(docs_of):
    block = KNOWN[6][1].split("\n\n")[0]
    got = by_id(license_scan(docs_of([(1, f"head\n\n{block}\n\ntail")]), known=[("A", block)]))
    assert got[1]["licenses"] == ["A"] and got[1]["n_paragraph_hits"] == 1 and got[1]["whole_license"] is None


def test_licence_edges(spark, docs_of):
    assert license_scan(spark.createDataFrame([], SCHEMA)).count() == 0
    line = "Licensed under CC BY-NC 4.0."
    twice = docs_of([(1, line), (1, line), (1, "no")]).withColumn("digest", F.lit(0)).withColumn("kind", F.lit(0))
    assert sorted(r["n_line_hits"] for r in license_scan(twice).collect()) == [0, 1, 1]
    neighbours = license_scan(docs_of([(1, "licence licence")]), known=[("L", "license license")]).collect()[0]
    assert neighbours["whole_license"] == "L"
    try:
        known_digests(spark, [("a", "b")] * 3, max_known=2)
    except ValueError:
        pass
    else:
        raise AssertionError("the bound is not checked")
