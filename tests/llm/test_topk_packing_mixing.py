"""Exact top-k, packing and mixing against plain versions."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from squall.llm.binpack import CAPACITIES, OPEN_COST, best_fit_pack, pack
from squall.llm.pfair import edf_period, in_mix_order, integer_weights, mix_sources, phases
from squall.llm.taat_topk import embedding_top_k

VECTORS = "vec_id long, embedding array<float>"


def plain_top_k(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, a in ok:
        if q % 50 == 0:
            best = out.setdefault(q, {})
            for c, b in ok:
                if c != q:
                    best[c] = max(best.get(c, -10 ** 18), sum(x * y for x, y in zip(a, b, strict=False)))
    return {q: sorted(((-s, c) for c, s in b.items()))[:k] for q, b in out.items()}


def listed(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((-r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return dict(out)


def test_topk_ties_zeros_and_blocks(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([0.0, 0.0, 0.5, -0.5, 0.25]) for _ in range(6)]) for i in range(400)]
    got = embedding_top_k(spark.createDataFrame(rows, VECTORS).repartition(4), block_rows=37, query_rows=3, lanes=4)
    assert listed(got) == plain_top_k(rows)


def test_topk_odd_vectors_and_repeats(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [0.5]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]),
            (4, [float("inf"), 0.0]), (5, []), (6, [3.0, 1.0, 9.0]), (6, [0.1, 0.1]), (None, [9.0, 9.0]), (7, [0.0, 0.0]),
            (-50, [1.0, -1.0])]
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("x")).withColumn("lane", F.lit(1))
    assert listed(embedding_top_k(df)) == plain_top_k(rows)
    assert embedding_top_k(spark.createDataFrame([], VECTORS)).count() == 0


def test_topk_large_group_of_equal_vectors(spark):
    rows = [(i, [1.0, 0.5]) for i in range(300)] + [(1000 + i, [0.1 * (i % 7), 0.3]) for i in range(100)]
    assert listed(embedding_top_k(spark.createDataFrame(rows, VECTORS), block_rows=64)) == plain_top_k(rows)


def plain_pack(lengths, capacities, open_cost):
    """Best fit over all open bins, by scanning lists: bins as [room, time of
    the last change, pieces]."""
    waiting, bins = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)), []
    for at, i in enumerate(waiting):
        n = lengths[i]
        holds = [b for b in bins if b[0] >= n]
        if not holds:
            left = sum(lengths[k] for k in waiting[at + 1:]) - sum(b[0] for b in bins)
            costs = []
            for c in capacities:
                room = c - n
                for k in waiting[at + 1:]:  # on trial: the longest that fits, again and again
                    room -= lengths[k] if lengths[k] <= room else 0
                if c >= n:
                    costs.append(((c + open_cost) / (n + min(c - n - room, max(0, left))), -c))
            holds = [[-min(costs)[1], 0, []]]
            bins += holds
        best = min(holds, key=lambda b: (b[0], -b[1]))
        best[0] -= n
        best[1] = at
        best[2].append(i)
    return [(min(c for c in capacities if c >= sum(lengths[i] for i in m)), m) for _, _, m in bins]


@pytest.mark.parametrize("seed", range(6))
def test_pack_is_the_plain_best_fit(seed):
    rnd = random.Random(seed)
    caps = (16, 32, 64)
    lengths = [rnd.randint(1, 64) if rnd.random() < 0.5 else rnd.randint(1, 9) for _ in range(200)]
    assert pack(lengths, caps, 3) == plain_pack(lengths, caps, 3)


def test_packing_places_every_word_once(spark, docs_of):
    rnd = random.Random(7)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 300, 5000, 9000]))) for i in range(60)] + [(3, "again"), (None, "x")]
    rows += [(70, None)]
    got = best_fit_pack(docs_of(rows).withColumn("piece", F.lit(0)).withColumn("n", F.lit("a")), chunk=25).collect()
    words = Counter()
    bins = defaultdict(list)
    for r in got:
        words[r["doc_id"]] += r["length"]
        if r["length"]:
            bins[r["bin_part"], r["bin_chunk"], r["bin_no"]].append(r)
        else:
            assert r["capacity"] is None
    assert words == Counter({d: 0 for d, _ in rows}) + Counter() or all(
        words[d] == sum(len((t or "").split()) for x, t in rows if x == d) for d in {d for d, _ in rows})
    for members in bins.values():
        members.sort(key=lambda r: r["bin_offset"])
        at = 0
        for r in members:
            assert r["bin_offset"] == at
            at += r["length"]
        smaller = [c for c in CAPACITIES if c < members[0]["capacity"]]
        assert at <= members[0]["capacity"] and all(at > c for c in smaller)
    assert best_fit_pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_packing_of_the_table_wastes_little(spark, real_rows):
    from squall.llm import queries
    got = queries.op5_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"] for r in got} == {d for d, _ in real_rows}
    bins = {(r["bin_part"], r["bin_chunk"], r["bin_no"]): r["capacity"] for r in got if r["length"]}
    assert sum(r["length"] for r in got) >= 0.9 * sum(bins.values())
    assert OPEN_COST > 0


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_packing_of_many_small_inputs_fills_as_well(spark, docs_of, parts):
    rnd = random.Random(parts)
    rows = [(i, " ".join(["w"] * rnd.randint(1, 900))) for i in range(640)]
    whole = pack([len(t.split()) for _, t in rows])  # all in one go
    got = best_fit_pack(docs_of(rows).repartition(parts)).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == sorted((i, len(t.split())) for i, t in rows)
    bins, held = {}, Counter()
    for r in got:
        k = r["bin_part"], r["bin_chunk"], r["bin_no"]
        bins[k] = r["capacity"]
        held[k] += r["length"]
    assert all(held[k] <= c for k, c in bins.items())
    assert sum(bins.values()) <= 1.03 * sum(c for c, _ in whole)


@pytest.mark.parametrize("shares", [{"a": 1}, {"a": 1, "b": 1}, {"a": 500, "b": 333, "c": 167}, {"a": 997, "b": 1, None: 2},
                                    {f"s{i}": 1 + i * i % 17 for i in range(30)}])
def test_edf_stays_within_one_block(shares):
    period = sum(shares.values())
    slots = edf_period(shares)
    assert sorted(t for s in slots.values() for t in s) == list(range(period))
    for k, a in shares.items():
        assert len(slots[k]) == a
        for j, t in enumerate(slots[k]):  # inside its window
            assert j * period // a <= t < -(-(j + 1) * period // a)


def test_phases_run_every_block_once():
    blocks = {"a": 700, "b": 13, "c": 0, "d": 290}
    shares = integer_weights({"a": 0.5, "b": 0.2, "c": 0.1, "d": 0.2}, 10)
    runs = {}
    for k, first, end, base, period, a, slots in phases(blocks, shares):
        for j in range(end - first):
            runs[base + j // a * period + slots[j % a]] = (k, first + j)
    assert sorted(runs) == list(range(sum(blocks.values())))
    assert Counter(k for k, _ in runs.values()) == Counter({k: n for k, n in blocks.items() if n})
    # with all three alive the mix is the target's, to less than a block
    seen = Counter()
    for t in range(40):
        seen[runs[t][0]] += 1
        for k in "abd":
            assert abs(seen[k] - (t + 1) * shares[k] / (shares["a"] + shares["b"] + shares["d"])) < 1


def test_mix_of_a_table(spark, docs_of):
    rows = [(i, f"t{i}", "big" if i % 3 else f"s{i % 5}") for i in range(900)] + [(5000 + i, "n", None) for i in range(40)]
    rows += [(7, "again", "big"), (None, "x", "big")]
    df = docs_of(rows).withColumn("slots", F.lit(1)).withColumn("mix_slot", F.lit("mine"))
    got = mix_sources(df, block_docs=4, bucket_docs=50)
    assert got.columns == ["doc_id", "text", "source", "slots", "source_block", "mix_slot", "mix_position"]
    out = sorted(got.collect(), key=lambda r: r["mix_position"])
    assert len(out) == len(rows) and len({r["mix_position"] for r in out}) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r["source"]].append(r["source_block"])
    for s, n in Counter(s for *_, s in rows).items():
        assert by[s] == [i // 4 for i in range(n)]
    again = sorted(mix_sources(df.repartition(7), block_docs=4, bucket_docs=50).collect(), key=lambda r: r["mix_position"])
    assert [(r["source"], r["mix_position"]) for r in again] == [(r["source"], r["mix_position"]) for r in out]
    ordered = [r["mix_position"] for r in in_mix_order(got).collect()]
    assert ordered == sorted(ordered)


def test_mix_edges(spark, docs_of):
    assert mix_sources(spark.createDataFrame([], "doc_id long, source string")).count() == 0
    with pytest.raises(ValueError):
        mix_sources(docs_of([(i, "", f"s{i}") for i in range(5)]), max_sources=4)
    with pytest.raises(ValueError):
        mix_sources(docs_of([(1, "", "a"), (2, "", "b")]), weights={"a": 1.0})
    one = mix_sources(docs_of([(i, "", "a") for i in range(50)]), weights={"a": 1.0, "unused": 3.0}, block_docs=8)
    assert sorted(r["mix_position"] for r in one.collect()) == list(range(50))
