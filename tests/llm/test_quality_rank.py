"""Quality ranking on held-out labels, and its parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from squall.llm import quality_rank as R
from squall.llm import queries as corpus

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def judged(spark):
    got = corpus.op11_quality_ranking(spark, SF)
    return got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()


def test_held_out_accuracy(judged):
    rows = [r for r in judged if r["held_out"]]
    good, bad = ([r for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(r["predicted"] for r in good) >= 0.98 * len(good)
    assert sum(r["predicted"] for r in bad) <= 0.05 * len(bad)
    better = sum(g["score"] > b["score"] for g in good for b in bad)
    assert better >= 0.99 * len(good) * len(bad)


def test_threshold_is_the_cut_and_every_document_is_scored(spark, judged):
    assert all((r["score"] >= 0.3) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in judged)
    assert corpus.op11_quality_ranking(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("quality", F.when(R.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = R.fit(docs, labels), R.fit(docs, turned)
    assert np.array_equal(a.weights, b.weights) and a.cut == b.cut


def test_pairs_learn_the_order():
    rng = np.random.default_rng(0)
    x = rng.random((400, 2))
    good = x[:, 0] + 0.1 * rng.standard_normal(400) > 0.3
    m = R.train(x, good, float((~good).mean()))
    s = R.strengths(x, m)
    assert s[good].mean() > s[~good].mean() and abs((s < m.cut).mean() - (~good).mean()) < 0.02
    assert np.all(R.scores(x, m)[s > m.cut] >= R.CUT)


def test_edges(spark):
    schema = "doc_id long, text string, score string, predicted string, mine long"
    rows = [(None, None, "x", "y", 1), (1, "", "x", "y", 2), (1, "Word " * 400_000, "x", "y", 3), (2, " \n ", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 0), (4, 0), (6, 1), (7, 0), (8, 1)], "doc_id long, quality int")
    many = docs.unionByName(spark.createDataFrame([(i, f"text {i}", "", "", i) for i in range(3, 30)], schema))
    got = R.score_documents(many, R.fit(many, labels)).collect()
    assert len(got) == 31 and all(0 <= r["score"] <= 1 for r in got) and {"mine", "score", "predicted"} <= set(got[0].asDict())
    assert R.fit(docs, labels.filter("quality = 1")) is None
    assert {r["score"] for r in R.score_documents(docs, None).collect()} == {0.5}
    assert R.score_documents(docs.limit(0), None).collect() == []


def test_every_labelled_row_is_learnt(spark):
    """The longest words are in the rows that a choice by the id's hash takes last."""
    n = 12_000
    ids = spark.range(n).filter(~R.held_out(F.col("id"))).withColumn("y", (F.col("id") % 3 > 0).cast("int"))
    last = {r["y"]: r["i"] for r in ids.groupBy("y").agg(F.max_by("id", F.xxhash64("id")).alias("i")).collect()}
    word = F.when(F.col("id") == last[1], F.repeat(F.lit("g"), 90)).when(F.col("id") == last[0], F.repeat(F.lit("b"), 70))
    text = F.concat_ws(" ", F.lit("some words and"), F.coalesce(word, F.col("id").cast("string")))
    docs = ids.select(F.col("id").alias("doc_id"), text.alias("text"))
    m = R.fit(docs, ids.select(F.col("id").alias("doc_id"), F.col("y").alias("quality")))
    assert {90.0, 70.0} <= set(m.edges[14])  # ends of both classes' longest word


def test_weights_are_those_of_all_pairs():
    rng = np.random.default_rng(3)
    x = rng.random((700, 3)).astype(np.float32)
    good = x[:, 0] - 0.5 * x[:, 1] ** 2 + 0.2 * rng.standard_normal(700) > 0.1
    m = R.train(x, good, float((~good).mean()))
    f = R.ramps(x, m.edges)
    diff = (f[good][:, None] - f[~good][None]).reshape(-1, f.shape[1])

    def loss(w):
        return np.log1p(np.exp(-(diff @ w))).mean() + R.DECAY / 2 * w @ w
    steep = -(1 / (1 + np.exp(diff @ m.weights))) @ diff / len(diff) + R.DECAY * m.weights
    assert np.abs(steep).max() < 1e-3
    assert all(loss(m.weights) < loss(m.weights + 0.3 * rng.standard_normal(len(m.weights))) for _ in range(20))
    s = np.sort(R.strengths(x, m))
    assert s[(~good).sum() - 1] < m.cut < s[(~good).sum()]


def test_quantiles_are_values_of_the_rows():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.standard_normal((501, 2)), np.zeros((100, 2)), -np.zeros((3, 2))]).astype(np.float32)
    good = rng.random(len(x)) > 0.3
    at = np.linspace(0, 1, 5)
    got = R._quantiles(lambda block: block(x, good), np.array([(~good).sum(), good.sum()], float), 2, at)
    for c in (0, 1):
        assert np.array_equal(got[c], np.quantile(x[good == c], at, axis=0, method="lower").T)
