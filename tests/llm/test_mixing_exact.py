"""Mixing by exact weights, for any number of sources."""

import random
from collections import defaultdict

import pytest

from squall.llm.pfair import deal_slots, mix_sources


@pytest.mark.parametrize(("n", "most", "big"), [(3, 60, 90), (40, 60, 90), (400, 20, 90), (12, 60, 20_000)])
def test_slots_stay_within_a_block_of_the_exact_weights(n, most, big):
    rnd = random.Random(n)
    blocks = [rnd.randint(0, most) for _ in range(n)] + [big]
    weights = [rnd.random() ** 3 + 1e-4 for _ in blocks]
    ran, ideal, live = [0] * len(blocks), [0.0] * len(blocks), {k for k, b in enumerate(blocks) if b}
    for i in deal_slots(blocks, weights):
        ran[i] += 1
        time = 1.0  # one slot of the ideal mix, sources leaving inside it
        while live and time > 1e-12:
            total = sum(weights[k] for k in live)
            step = min([time, *((blocks[k] - ideal[k]) * total / weights[k] for k in live)])
            for k in live:
                ideal[k] += step * weights[k] / total
            time -= step
            live = {k for k in live if blocks[k] - ideal[k] > 1e-9}
        assert max(abs(a - b) for a, b in zip(ran, ideal, strict=True)) < 1 + 1e-6
    assert ran == blocks


def test_weights_are_not_rounded_to_shares():
    # a share of 1 in 3,000 was dealt as 1 in 1,000: 20 blocks too many here
    seen = 0
    for t, i in zip(range(30_000), deal_slots([100_000, 100], [2999.0, 1.0]), strict=False):
        seen += i == 1
        assert abs(seen - (t + 1) / 3000) < 1 + 1e-6


def test_mix_of_many_sources(spark, docs_of):
    rows = [(i, "t", f"host{i % 700}") for i in range(2100)] + [(9000 + i, "t", "big") for i in range(500)]
    got = mix_sources(docs_of(rows), block_docs=2, bucket_docs=300).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    slots = defaultdict(set)
    for r in got:
        slots[r["mix_slot"]].add((r["source"], r["source_block"]))
    assert all(len(s) == 1 for s in slots.values()) and sorted(slots) == list(range(700 * 2 + 250))
    # all sources are alive at first: the big one has its share of the slots
    share, big = 500 ** 0.5 / (500 ** 0.5 + 700 * 3 ** 0.5), 0
    for t in range(1000):
        big += next(iter(slots[t]))[0] == "big"
        assert abs(big - (t + 1) * share) < 1
