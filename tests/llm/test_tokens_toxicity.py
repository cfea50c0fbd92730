"""Token files (exact round trip) and toxicity (held-out accuracy, gradients)."""

import math
import random
import zlib

import numpy as np
from brute import token_rows
from pyspark.sql import functions as F

from squall.llm import toxicity_crf as T
from squall.llm.token_files import (
    Encoder,
    blocks_of,
    build_index,
    fetch,
    locate,
    look_up,
    read_token_files,
    vocabulary_path,
    write_and_read_back,
    write_token_files,
)

SCHEMA = "doc_id long, text string, source string"
ODD = ["L'été, ÉTÉ's it's DON'T x'LL <|endoftext|> a<|startoftext|>b\x1c\x1d z", "ǅ İstanbul ΣΑΣ é ﬁ ① ½ ² ª º µ ÷ × ÿ ß",
       "日本語 テスト 😀👍🏽 á́", "Ñandú ÀÉÎÕÜ---££¥ \x7f\xad", "  ", "", None, "3a 4é ñ5 _x_ \x00y"]


def test_whole_table(spark, real_rows):
    from squall.llm import queries
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"])
           for r in queries.op8_token_files(spark, "/root/testdata/sf0.001").collect()}
    assert got == token_rows(real_rows, vocabulary_path())


def test_odd_texts_in_both_encoders(spark, docs_of):
    rows = list(enumerate(ODD))
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = vocabulary_path(name)
        got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"])
               for r in write_and_read_back(docs_of(rows), tokenizer=path).collect()}
        assert got == token_rows(rows, path)
    assert Encoder(vocabulary_path()).by_word and not Encoder(vocabulary_path("byte_bpe_50k.json")).by_word


def test_fetch_by_key(spark, docs_of, tmp_path):
    path = f"{tmp_path}/ids"
    rows = [(i * 7, f"word{i} and more") for i in range(500)]
    write_token_files(docs_of(rows), path)
    enc = Encoder(vocabulary_path())
    got = {r["doc_id"]: r["ids"] for r in fetch(spark, path, [0, 7, 3, 3493, -1, 10 ** 9]).collect()}
    want = {d: [*np.frombuffer(enc.encode(t.encode()), enc.dtype).tolist(), 1] for d, t in rows if d in (0, 7, 3493)}
    assert got == want
    assert fetch(spark, path, []).count() == 0


def test_index_leads_from_key_to_block(spark, docs_of, tmp_path, monkeypatch):
    from squall.llm import token_files
    monkeypatch.setattr(token_files, "BLOCK_DOCS", 20)
    path = f"{tmp_path}/ids"
    rows = [(i * 3 - 90, f"w{i}") for i in range(400)] + [(600, f"again {i}") for i in range(50)] + [(None, "n")]
    write_token_files(docs_of(rows), path, shard_keys=16)
    n_blocks = spark.read.parquet(f"{path}/ids").count()
    assert n_blocks >= 20 and spark.read.parquet(f"{path}/index").count() > 20
    keys = spark.createDataFrame([(d,) for d in sorted({d for d, _ in rows if d is not None})], "doc_id long")
    found = {r["doc_id"]: (r["block"], r["place"]) for r in locate(spark, path, keys).collect()}
    assert len(found) == keys.count()
    first = found[600][0]
    read = blocks_of(spark, path, [found[-90][0], first, first])
    assert read.count() == 2 and len(read.inputFiles()) <= 2 < n_blocks
    assert {r["doc_id"] for r in fetch(spark, path, [-90, 600, -89]).collect()} == {-90, 600}
    got = read_token_files(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))


def test_blocks_stand_in_row_groups_of_their_own(spark, docs_of, tmp_path):
    import glob

    import pyarrow.parquet as pq
    rnd = random.Random(1)
    rows = [(i, " ".join(str(rnd.random()) for _ in range(30_000))) for i in range(12)]
    path = f"{tmp_path}/ids"
    write_token_files(docs_of(rows).coalesce(1), path)
    n_blocks = spark.read.parquet(f"{path}/ids").count()
    groups = sum(pq.ParquetFile(f).metadata.num_row_groups for f in glob.glob(f"{path}/ids/*.parquet"))
    assert groups == n_blocks >= 4


def test_repeated_null_and_missing_rows(spark, docs_of, tmp_path):
    assert write_and_read_back(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(2, "b"), (2, "a"), (2, "a"), (None, "n"), (None, None), (1, None), (3, "c d e")]
    df = docs_of(rows).withColumn("part", F.lit("x")).withColumn("n_tokens", F.lit(0))
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in write_and_read_back(df).collect())
    assert [(d, n) for _, d, n in got] == [(None, 1), (None, 2), (1, 1), (2, 2), (2, 2), (2, 2), (3, 4)]
    assert [s for s, *_ in got] == [0, 1, 3, 4, 6, 8, 10]


def test_very_long_text(spark, docs_of):
    rnd = random.Random(0)
    rows = [(1, "x"), (2, " ".join(str(rnd.random()) for _ in range(120_000))), (3, "y")]
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in write_and_read_back(docs_of(rows)).collect()}
    assert got == token_rows(rows, vocabulary_path())


def test_index_is_minimal_and_perfect():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5, 100, 4096):
        keys = np.unique(rng.integers(-2 ** 62, 2 ** 62, n))
        seeds, prints, places = build_index(keys)
        assert len(places) == len(keys) and sorted(places.tolist()) == list(range(len(keys)))
        assert look_up(keys, seeds, prints, places).tolist() == list(range(len(keys)))
        if n > 100:  # strangers: nearly all are turned away by the fingerprint
            others = rng.integers(2 ** 62, 2 ** 63 - 1, 20_000)
            assert (look_up(others, seeds, prints, places) >= 0).mean() < 0.001


def toxic_rows(n, seed):
    rnd = random.Random(seed)
    plain = [f"{a}{b}" for a in ("lor", "mip", "dos", "tan", "ver") for b in ("em", "sum", "lat", "quis", "ent", "ulla")]
    bad, stem = ["frackle", "snorb", "gribbit"], "zlom"
    rows = []
    for i in range(n):
        ws = [rnd.choice(plain) + rnd.choice(["", "s", "is"]) for _ in range(rnd.randint(5, 80))]
        toxic = rnd.random() < 0.25
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                w = rnd.choice(bad) if rnd.random() < 0.6 else stem + rnd.choice(plain)
                ws.insert(rnd.randint(0, len(ws)), w)
        rows.append((i, " ".join(ws), int(toxic)))
    return rows


def test_held_out_accuracy_and_spans(spark, docs_of):
    rows = toxic_rows(900, 1)
    docs = docs_of([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    got = {r["doc_id"]: r for r in T.score_documents(docs, model).select(
        "*", T.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(got[i]["h"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    held = [r for r in rows if got[r[0]]["h"]]
    assert len(held) > 100
    assert sum(got[i]["predicted"] == y for i, _, y in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    spans = [(got[i]["text"].encode()[s["start"]:s["end"]], y) for i, _, y in rows for s in got[i]["spans"]]
    hit = [any(w.startswith((b"frackle", b"snorb", b"gribbit", b"zlom")) for w in s.split()) for s, _ in spans]
    assert spans and sum(hit) >= 0.95 * len(spans)


def test_labels_of_the_held_out_fold_are_not_read(spark, docs_of):
    rows = toxic_rows(400, 2)
    docs = docs_of([(i, t) for i, t, _ in rows])
    flip = [(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, _, y in rows]
    a = T.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    b = T.fit(docs, spark.createDataFrame(flip, "doc_id long, toxic int"))
    assert np.array_equal(a.weights, b.weights) and a.link == b.link


def test_real_table_held_out(spark):
    from squall.llm import queries
    sf = "/root/testdata/sf0.01"
    got = queries.op9_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.filter("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.9 * len(rows)


def test_toxicity_edges(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = docs_of([(1, None), (2, ""), (None, "a b"), (2, "c"), (3, "1234 !!")]).withColumn("score", F.lit("x")).withColumn("spans", F.lit(1))
    assert T.fit(docs, none) is None
    assert [r["score"] for r in T.score_documents(docs, None).collect()] == [0.0] * 5
    rows = toxic_rows(300, 3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (6, 0)], "doc_id long, toxic int")
    model = T.fit(docs_of([(i, t) for i, t, _ in rows]), labels)
    got = T.score_documents(docs, model).collect()
    assert len(got) == 5 and all(r["predicted"] == 0 and r["spans"] == [] for r in got)
    assert T.score_documents(spark.createDataFrame([], SCHEMA), model).count() == 0
    long = docs_of([(1, "lorem " * 200_000 + "frackle snorb gribbit")])
    r = T.score_documents(long, model).collect()[0]
    assert math.isfinite(r["score"]) and r["n_spans"] >= 1


def test_chain_is_the_sum_over_all_taggings():
    """Marginals of short chains against enumeration."""
    rng = np.random.default_rng(5)
    trans, start = rng.normal(size=(2, 2)), 0.3
    model = T.Model(np.zeros(1), 0.0, trans, start, (1, 0, 0))
    lens = [1, 4, 7, 2]
    emit = rng.normal(size=sum(lens)) * 2
    first = np.zeros(len(emit), bool)
    first[np.cumsum(lens) - lens] = True
    got = T.marginals(emit, first, model)
    at = 0
    for n in lens:
        e, total, marg = emit[at:at + n], 0.0, np.zeros(n)
        for code in range(2 ** n):
            tags = [(code >> i) & 1 for i in range(n)]
            w = math.exp(sum(x * t for x, t in zip(e, tags, strict=True)) + start * tags[0]
                         + sum(trans[a, b] for a, b in zip(tags, tags[1:], strict=False)))
            total += w
            marg += w * np.array(tags)
        assert np.allclose(got[at:at + n], marg / total, atol=1e-9)
        at += n


def test_byte_slices_keep_every_row():
    import pyarrow as pa

    from squall.llm.common import byte_slices
    texts = [b"a" * 5, None, b"", b"b" * 30, b"c" * 4, b"d" * 6, b"e", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts, pa.binary())], ["k", "t"])
    parts = [p.column(1).to_pylist() for p in byte_slices(batch, 10)]
    assert parts == [texts[:3], texts[3:4], texts[4:6], texts[6:]]
    assert list(byte_slices(batch.slice(0, 0))) == []
