"""The corpus pipeline stage by stage."""

import corpus_pipeline as P
import pytest
from brute import near_duplicates
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        out[name] = (docs, docs := spark.read.parquet(path))
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "mixing", "packing"]
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == COLUMNS, name


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    left = {r["doc_id"] for r in after.select("doc_id").collect()}
    rows = labels.join(before.select("doc_id"), "doc_id").collect()
    clean, toxic = [r for r in rows if not r["toxic"]], [r for r in rows if r["toxic"]]
    assert sum(r["doc_id"] in left for r in clean) >= 0.95 * len(clean)
    assert sum(r["doc_id"] in left for r in toxic) <= 0.4 * len(toxic)


def test_near_duplicates_are_the_brute_force_ones(stages):
    before, after = stages["near_duplicates"]
    want = near_duplicates([(r["doc_id"], r["text"]) for r in before.collect()], size=5)
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == {d for d, (_, c) in want.items() if c == d}


def test_mixing_keeps_all_and_packing_takes_all(stages):
    before, after = stages["mixing"]
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    _, packed = stages["packing"]
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in after.collect()}


def test_run_gives_the_last_stage(spark, stages):
    got = P.run(spark, SF)
    assert got.columns == stages["packing"][1].columns
    assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in stages["packing"][1].collect()}


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stage_edges(spark, name):
    stage = dict(P.STAGES)[name]
    assert stage(spark, spark.createDataFrame([], SCHEMA), SF).count() == 0
    t = "one plain text of a few ordinary words, long enough to be looked at by every stage"
    rows = [(1, t, "en", "a", len(t)), (1, t, "en", "a", len(t)), (2, None, None, None, None), (3, "", "en", "b", 0),
            (None, "no id here", "en", None, 10), (4, "word " * 30_000, "en", "a", 150_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("mine")).withColumn("score", F.lit(9)).withColumn("key", F.lit(9))
    df = df.withColumns({c: F.lit("own") for c in ("kept_text", "n_lines", "mix_slot", "mix_position", "source_block", "spans")})
    got = stage(spark, df, SF)
    ids = sorted(str(r["doc_id"]) for r in got.select("doc_id").distinct().collect())
    assert ids == ["1", "2", "3", "4", "None"]
    if name != "packing":
        assert got.columns == df.columns
        assert {(r["kept"], r["score"], r["key"]) for r in got.collect()} == {("mine", 9, 9)}
        assert {tuple(r[-6:]) for r in got.collect()} == {("own",) * 6}
    if name == "near_duplicates":
        assert got.filter("doc_id = 1").count() == 1


def test_line_dedup_drops_only_what_it_empties(spark):
    line = "The same notice stands here on every site."
    rows = [(i, line if i % 2 else f"{line}\nown words {chr(97 + i)}x", "en", f"s{i}", 50) for i in range(30)]
    got = {r["doc_id"]: r["text"] for r in P.lines(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()}
    assert got[0] == rows[0][1]
    assert set(got) == {i for i in range(30) if i % 2 == 0} and got[2] == "own words cx"
