"""Suffix dedup against all windows of all documents."""

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
from brute import suffix_dedup as brute
from pyspark.sql import functions as F

from squall.llm.suffix_index import LogIndex, runs, suffix_dedup

SCHEMA = "doc_id long, text string, source string"


def digest(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept_bytes"]).hexdigest())
            for r in df.collect()}


def passages(seed, n, parts, words=12):
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choice("abcdefgé") * rnd.randint(1, 4) for _ in range(words)) for _ in range(parts)]
    return [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.6 else str(rnd.random()) for _ in range(rnd.randint(0, 9))))
            for i in range(n)]


def test_whole_table(spark, real_rows):
    from squall.llm import queries
    got = queries.op3_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    want = brute(real_rows)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want


def test_shared_passages_in_any_surroundings(docs_of):
    rows = passages(1, 120, 8)
    assert digest(suffix_dedup(docs_of(rows))) == brute(rows)


def test_hot_anchors_are_decided_by_window(docs_of):
    rows = passages(2, 120, 3)
    assert digest(suffix_dedup(docs_of(rows), hot=4)) == brute(rows)


def test_periodic_texts_and_lengths_around_the_limit(docs_of):
    rows = [(1, "a" * 49), (2, "a" * 50), (3, "a" * 51), (4, "ab" * 200), (5, "ba" * 90 + "x" * 60), (6, "x" * 49 + "y"),
            (7, "x" * 50), (8, None), (9, ""), (10, "x" * 300), (11, "é" * 25), (12, "é" * 26), (13, "ab" * 30 + "a" * 30)]
    assert digest(suffix_dedup(docs_of(rows))) == brute(rows)


def test_a_document_does_not_repeat_itself(docs_of):
    line = "The quick brown fox jumps over the lazy dog, again and again and again. "
    rows = [(1, line * 3), (2, "intro " + line + line), (3, line[5:60])]
    assert digest(suffix_dedup(docs_of(rows))) == brute(rows)


def test_very_long_text(docs_of):
    rnd = random.Random(3)
    long = "".join(rnd.choice("abcdef ") for _ in range(300_000))
    rows = [(1, long), (2, long[100_000:150_000] + "!" + long[:70]), (3, long)]
    got = digest(suffix_dedup(docs_of(rows)))
    assert got[1][1] == 0 and got[2][1] == 50_070 and got[2][2] == 2 and got[3][1] == 300_000


def test_repeated_rows_null_ids_and_clashing_names(spark, docs_of):
    assert suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    t = "0123456789" * 7
    rows = [(5, t), (5, t), (5, "other " + t), (9, t), (None, t), (None, "z" * 60)]
    df = docs_of(rows).withColumn("doc", F.lit("mine")).withColumn("kept_bytes", F.lit(0)).withColumn("mark", F.lit(0))
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["doc"]) for r in suffix_dedup(df).collect())
    assert got == [(0, 60, 0, "mine"), (0, 70, 70, "mine"), (5, 70, 0, "mine"), (5, 70, 0, "mine"), (5, 76, 0, "mine"),
                   (9, 70, 70, "mine")]


def test_log_index_levels_grow_geometrically():
    index, seen = LogIndex(), {}
    rnd = np.random.default_rng(0)
    for step in range(200):
        keys = np.unique(rnd.integers(0, 5000, 50))
        known, value = index.scan(keys)
        assert [seen.get(int(k), -1) for k in keys] == np.where(known, value, -1).tolist()
        index.add(keys[~known], np.full((~known).sum(), step))
        seen |= {int(k): step for k in keys[~known]}
        sizes = [len(k) for k, _ in index.levels]
        assert len(sizes) <= 14 and all(a > b for a, b in zip(sizes, sizes[1:], strict=False))


def test_equal_windows_have_equal_runs():
    rnd = np.random.default_rng(1)
    a = rnd.integers(97, 100, 500).astype(np.uint8)
    doc, at, n, anchor, key = runs(np.concatenate([a, a[100:400]]), np.array([500, 300]), 50, 16)
    own = {(int(x), int(k)) for d, x, k in zip(doc, anchor, key, strict=True) if d == 0}
    inner = [(int(x), int(k)) for d, x, k in zip(doc, anchor, key, strict=True) if d == 1][1:-1]
    assert inner and set(inner) <= own
    assert n[doc == 0].sum() == 451 and n[doc == 1].sum() == 251


def test_texts_above_a_batch_are_cut_in_pieces(docs_of, monkeypatch):
    from brute import suffix_dedup as plain

    from squall.llm import suffix_index
    monkeypatch.setattr(suffix_index, "BATCH_BYTES", 300)
    rnd = np.random.default_rng(5)
    a = "".join(map(chr, rnd.integers(97, 123, 2000)))
    rows = [(1, a), (2, a[700:1500] + "x" * 400), (3, "tail " + a[290:360] + " and " + a[1200:]), (4, "é" * 500), (5, a)]
    got = suffix_dedup(docs_of(rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == plain(rows)


def found_by(monkeypatch, after=lambda df: None):
    """The decided runs of each call, as they are written."""
    from squall.llm import suffix_index
    kept, real = [], suffix_index.scratch_table

    def table(df, *args, **options):
        kept.append(real(df, *args, **options))
        after(df)
        return kept[-1]
    monkeypatch.setattr(suffix_index, "scratch_table", table)
    return kept


def around(seed, phrase, n=80):
    """Texts that have nothing in common but a phrase."""
    rnd = random.Random(seed)
    noise = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rnd.randint(60, 150)))
    return [(i, "".join(noise() + phrase for _ in range(3)) + noise()) for i in range(n)]


def test_runs_that_share_no_window_are_not_contested(docs_of, monkeypatch):
    found = found_by(monkeypatch)
    rows = around(6, "these are twenty-eight bytes")
    assert digest(suffix_dedup(docs_of(rows))) == brute(rows)
    assert found[0].filter("kind >= 2").count() == 0
    rows = around(7, "while these are more than fifty bytes, and so they go from all but the first")
    want = brute(rows)
    assert digest(suffix_dedup(docs_of(rows))) == want and sum(w[1] for w in want.values()) > 79 * 3 * 70
    assert found[1].filter("kind >= 2").count() > 0


def test_shuffle_files_of_the_runs_go_with_their_job(spark, docs_of, monkeypatch):
    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_") and n.endswith(".data")}

    def left(df):
        end = time.time() + 20
        while shuffled() - before and time.time() < end:
            time.sleep(0.2)
        after.append(shuffled() - before)

    rows, after = passages(8, 60, 6), []
    docs = docs_of(rows).localCheckpoint()
    found_by(monkeypatch, left)
    from squall.llm import suffix_index
    real = suffix_index.shuffle_parts
    before = set()
    monkeypatch.setattr(suffix_index, "shuffle_parts", lambda s: before.update(shuffled()) or real(s))
    assert digest(suffix_dedup(docs)) == brute(rows)
    assert after == [set()]
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key, "false") == "false"


def test_hot_windows_travel_without_their_bytes():
    from squall.llm.suffix_index import _PART, HOTLY, _parts
    text = bytes(np.random.default_rng(2).integers(97, 123, 300).astype(np.uint8))
    runs_ = [{"deal": 0, "kind": HOTLY, "at": 20, "n": 100}]
    batch = pa.RecordBatch.from_arrays([pa.array([3]), pa.array([0]), pa.array([text]), pa.array([runs_])], ["doc", "mark", "t", "runs"])
    out = pa.Table.from_batches(_parts(50, 1 << 20)(iter([batch])))
    assert out.schema.names == [f.split()[0] for f in _PART.split(", ")]
    assert sorted(out["at"].to_pylist()) == list(range(20, 120)) and out["data"].null_count == 100


def test_few_letters_and_periods(docs_of):
    rnd = random.Random(9)
    piece = lambda: rnd.choice(["ab" * rnd.randint(1, 60), "a" * rnd.randint(1, 90), "abc" * rnd.randint(1, 40),
                                "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 120)))])
    rows = [(rnd.randint(0, 1 << 40), "".join(piece() for _ in range(rnd.randint(0, 6)))) for _ in range(150)]
    for hot in (2, 4096):
        assert digest(suffix_dedup(docs_of(rows), hot=hot)) == brute(rows)


def test_run_index_keeps_the_least_document_in_any_order():
    from squall.llm.suffix_index import _DECIDED, _ENTRY, RunIndex, _pack, _unpack
    rnd = np.random.default_rng(3)
    index, gone, rows = RunIndex(), [], []
    for batch in range(60):
        n = int(rnd.integers(1, 60))
        new = [np.sort(rnd.integers(0, 1 << 63, 40, dtype=np.uint64)[rnd.integers(0, 6, n)] if batch % 9 == 8
                       else rnd.integers(0, 40, n).astype(np.uint64) << np.uint64(55)),
               rnd.integers(1, 4, n), rnd.integers(0, 1 << 32, n), rnd.integers(-50, 50, n), rnd.integers(0, 9, n),
               np.arange(n) + 100 * batch, rnd.integers(1, 36, n)]
        new = [c.astype(t) for c, t in zip(new, _ENTRY, strict=True)]
        packed = _unpack(_pack(new, _ENTRY), _ENTRY)
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(new, packed, strict=True))
        gone.append(index.add([packed]))
        rows += zip(*(c.tolist() for c in new), strict=True)
        sizes = [len(x[0]) for x in index.levels]
        assert len(sizes) <= 12 and all(a > b for a, b in zip(sizes, sizes[1:], strict=False))
    kept, last = index.whole()
    least = {}
    for a, k, _, d, *_ in rows:
        least[a, k] = min(d, least.get((a, k), d))
    assert sorted(zip(*(c.tolist() for c in kept), strict=True)) == sorted(r for r in rows if r[3] == least[r[:2]])
    gone = [np.concatenate(c).tolist() for c in zip(*gone, last, strict=True)]
    assert sorted(zip(*gone[1:], strict=True)) == sorted(r[3:] for r in rows if r[3] > least[r[:2]])
    decided = [np.array([-1, 5, 2]), np.array([1 << 62, -3, 0]), np.array([7, 8, -(1 << 63)]), np.array([1, 2, 3]), np.array([4, 5, 6])]
    decided = [c.astype(t) for c, t in zip(decided, _DECIDED, strict=True)]
    assert all((a == b).all() for a, b in zip(decided, _unpack(_pack(decided, _DECIDED), _DECIDED), strict=True))
