"""Prefix trie against a plain one, and its list ranking on its own."""

import random

import pytest
from brute import prefix_trie as plain
from pyspark.sql import functions as F

from squall.llm import prefix_trie as T
from squall.llm.ordering import numbered, running

SCHEMA = "conv_id long, turn long, role string, text string"


def compare(spark, rows, **options):
    got = T.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows), key=repr)
    return got


def conversations(seed, n, turns):
    r = random.Random(seed)
    return [(r.choice([c, c, c * 7 - 300]), t, r.choice("ua"), r.choice(["x", "yy", "É", ""]))
            for c in range(n) for t in range(r.randrange(1, turns))]


@pytest.mark.parametrize("options", [{}, {"block": 8, "few": 10}])
def test_random_conversations(spark, options):
    rows = list(dict.fromkeys((c, t) for c, t, *_ in conversations(1, 250, 9)))
    r = random.Random(2)
    compare(spark, [(c, t, r.choice("ua"), r.choice(["x", "yy", "É", ""])) for c, t in rows], **options)


def test_hot_copies_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 600) for t in range(3)]
    rows += [(5000, t, "user", f"t{t}") for t in range(150)]
    compare(spark, rows, block=64, few=50)


def test_nulls_ties_empty_texts_and_turnless_conversations(spark):
    rows = [(None, 0, "u", "a"), (None, None, None, None), (3, None, "u", None), (3, 0, None, "b"), (4, 0, "u", "x"),
            (4, 0, "u", "x"), (4, 1, "", ""), (-150, 0, "u", "n"), (-100, 0, "u", "m"), (-100, 1, "u", "k")]
    rows += [(c, 0, "u", "only") for c in range(101, 120)]  # their base has no turns: some lose their own
    got = compare(spark, rows)
    assert any(r["depth"] == 0 and r["parent_conv_id"] is None for r in got)


def test_empty_table_and_other_columns(spark):
    assert T.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, 0, "u", "Long " * 300_000), (1, 1, "a", "z"), (2, 0, "u", "q")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("depth", "pos", "a", "conv", "nid", "at")})
    assert sorted(map(tuple, T.prefix_trie(df).collect()), key=repr) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("n", [1, 2, 50, 700])
def test_list_rank_of_a_shuffled_list(spark, n):
    order = list(range(n))
    random.Random(n).shuffle(order)
    arcs = [(a, b) for a, b in zip(order, [*order[1:], None], strict=True)]
    got = T.list_rank(spark.createDataFrame(arcs, "id long, nxt long"), block=16, few=8).collect()
    assert {r["id"]: r["at"] for r in got} == {a: i for i, a in enumerate(order)}


def test_numbered_and_running_go_on_across_ranges_and_blocks(spark):
    rows = [("hot", i % 50) for i in range(900)] + [("b", 2), ("b", None), ("c", 1)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(7)
    got = numbered(df, ["g"], ["v"], "test-order").collect()
    for g in "hot", "b", "c":
        own = sorted((r["idx"], r["v"]) for r in got if r["g"] == g)
        assert [i for i, _ in own] == list(range(len(own)))
        assert [v for _, v in own] == sorted((v for _, v in own), key=lambda v: (v is not None, v or 0))
    line = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").alias("at"), (F.col("id") * 3 % 7).alias("v"))
    got = running(line, ["g"], "at", {"s": "v"}, F.sum, lambda a, b: a + b, block=16).orderBy("at").collect()
    total = 0
    for r in got:
        total += r["v"]
        assert r["s"] == total
