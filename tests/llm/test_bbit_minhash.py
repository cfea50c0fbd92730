"""Near-duplicate components against all pairs."""

import random

import numpy as np
from brute import near_duplicates as brute
from pyspark.sql import functions as F

from squall.llm import bbit_minhash as M

SCHEMA = "doc_id long, text string, source string"


def result(df):
    out = {}
    for r in df.collect():
        assert r["kept"] == (r["doc_id"] == r["component_id"])
        out[r["doc_id"]] = (r["n_shingles"], r["component_id"])
    return out


def family(seed, n, words, edits):
    """One text with a few words changed at random in each copy."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 99999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rnd.randint(0, edits)):
            t[rnd.randrange(words)] = f"e{rnd.randint(0, 99999)}"
        out.append(" ".join(t))
    return out


def test_whole_table(spark, real_rows):
    from squall.llm import queries
    assert result(queries.op7_minhash_dedup(spark, "/root/testdata/sf0.001")) == brute(real_rows)


def test_loose_families_lose_no_link(docs_of):
    texts = family(1, 90, 120, 12) + family(2, 40, 60, 6) + family(3, 5, 300, 3)
    random.Random(4).shuffle(texts)
    rows = list(enumerate(texts))
    got = result(M.near_duplicates(docs_of(rows), shingle=4))
    want = brute(rows)
    assert got == want
    assert 10 < len({c for _, c in want.values()}) < len(rows) - 20  # some linked, some not


def test_blocks_split_large_components(docs_of, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_DOCS", 8)
    rows = list(enumerate(family(5, 80, 100, 14)))
    assert result(M.near_duplicates(docs_of(rows), shingle=4)) == brute(rows)


def test_chain_of_links_reaches_its_smallest_id(docs_of):
    words = [f"c{i}" for i in range(400)]
    rows = [(100 - i, " ".join(words[i * 8:i * 8 + 100])) for i in range(20)]  # each like the next only
    got = result(M.near_duplicates(docs_of(rows), shingle=4))
    assert got == brute(rows) and {c for _, c in got.values()} == {81}


def test_default_is_five_words_at_four_fifths(docs_of):
    rows = list(enumerate(family(6, 40, 80, 5)))
    assert result(M.near_duplicates(docs_of(rows))) == brute(rows, size=5)


def test_short_blank_and_null_texts(docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO\n"), (6, "one"), (7, "one two three"),
            (8, "one two three four"), (9, "É a b c"), (10, "é a b c")]
    got = result(M.near_duplicates(docs_of(rows), shingle=4))
    assert got == brute(rows)
    assert got[5] == (1, 4) and got[10] == (1, 10) and got[2] == (0, 2)


def test_repeated_rows_null_ids_clashing_names_and_empty(spark, docs_of):
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    t = " ".join(f"q{i}" for i in range(30))
    df = docs_of([(3, t), (3, t), (2, t + " more"), (None, t), (None, "alone by itself here and now"), (None, None)])
    df = df.withColumn("rep", F.lit(1)).withColumn("bands", F.lit("x")).withColumn("component_id", F.lit(0))
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in M.near_duplicates(df).collect())
    assert got == [("2", "2", True), ("3", "2", False), ("3", "2", False), ("None", "2", False), ("None", "None", True),
                   ("None", "None", True)]


def test_documents_without_id_link_like_others(docs_of):
    words = [f"n{i}" for i in range(60)]
    near = [" ".join([*words[:k], "other", *words[k + 1:]]) for k in (0, 59)]
    far = [" ".join(f"f{k}" for k in range(i * 100, i * 100 + 40)) for i in range(3)]
    rows = [(None, near[0]), (None, near[1]), (5, " ".join(words)), (None, far[0]), (None, far[0] + " end"), (9, far[1])]
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"], r["n_shingles"])
                 for r in M.near_duplicates(docs_of(rows), shingle=4).collect())
    assert got == [("5", "5", True, 57), ("9", "9", True, 37), ("None", "5", False, 57), ("None", "5", False, 57),
                   ("None", "None", True, 37), ("None", "None", True, 38)]
    # a chain whose middle has no id holds its ends together
    chain = [" ".join(words[i * 6:i * 6 + 60 - 12]) for i in range(3)]
    ends = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(
        docs_of([(1, chain[0]), (None, chain[1]), (2, chain[2])]), shingle=4, percent=70).collect()}
    assert ends == {1: 1, 2: 1, None: 1}


def test_very_long_text(docs_of):
    words = [f"v{i}" for i in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[3000:])), (3, " ".join(words[20_000:]))]
    got = result(M.near_duplicates(docs_of(rows)))
    assert [got[i][1] for i in (1, 2, 3)] == [1, 1, 3]


def test_estimate_is_unbiased(spark):
    rng = np.random.default_rng(0)
    for share in (0.3, 0.8):
        rows = []
        for i in range(200):
            pool = np.unique(rng.integers(0, 2 ** 63, 1200, dtype=np.uint64))[:1000]
            both = int(1000 * share)
            a, b = pool[:both + (1000 - both) // 2], np.concatenate([pool[:both], pool[both + (1000 - both) // 2:]])
            rows.append((M.packed(M.minima(a)).tolist(), M.packed(M.minima(b)).tolist()))
        got = spark.createDataFrame(rows, "a array<long>, b array<long>").select(
            M.estimate(F.col("a"), F.col("b")).alias("e")).toPandas()["e"]
        assert abs(got.mean() - share) < 0.015
        assert got.std() < 0.06
