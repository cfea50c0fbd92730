"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of ``block_docs`` documents and one block runs
per slot.  In the ideal mix every live source runs all the time at its exact
share, weight over the weights of the live sources; when one has run out, the
rest go on in proportion.  In virtual time (slots divided by the live weight)
block j (from 0) of a source of weight w runs from j / w to (j + 1) / w.  A
block may run in a slot if its ideal run starts before the slot's end, and the
one whose ideal run ends first is taken.  The ideal run fills every slot, so
earliest deadline first meets every window: after any number of slots each
source is less than one block away from its target, for as long as the table
lasts and however many sources there are.  Weights are never rounded.

The slots are dealt by one task that reads one row per source and keeps one
entry per source; it steps through blocks, never through documents, and sends
its rows on as they come.  Nothing is dropped or repeated.

Documents are numbered within their source by counts of hash buckets (about
``bucket_docs`` rows each) and a rank inside the bucket, so a source with a
third of all rows is spread over many tasks.  The slots of a bucket's blocks
meet its documents as one array, under the key by which the rank was dealt.

Defined cases: a null source is a source of its own; documents of a source
are ordered by (hash of the id, id), so rows that repeat an id are neighbours
and each gets a place; a null id is an id; more than ``max_sources`` sources
raise an error if that is given (by default any number is mixed); a missing
weight means no target and raises an error; an empty table gives an empty
result; input columns named like an output column are replaced.

``integer_weights``, ``edf_period`` and ``phases`` are the periodic form for
small integer weights; ``mix_sources`` does not use them.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.common import cut_lineage

BLOCK_DOCS = 16
BUCKET_DOCS = 20_000
RESOLUTION = 1000

_OUT = ["source_block", "mix_slot", "mix_position"]
_SLOTS = "key string, block long, slot long"
_ROWS = 50_000  # slots per batch sent on


def integer_weights(weights: dict, resolution: int = RESOLUTION) -> dict:
    """Shares of ``resolution`` by largest remainder, one at least."""
    total = sum(weights.values())
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    exact = {k: w / total * resolution for k, w in weights.items()}
    out = {k: max(1, math.floor(x)) for k, x in exact.items()}
    left = resolution - sum(out.values())
    for k in sorted(exact, key=lambda k: (math.floor(exact[k]) - exact[k], str(k)))[: max(0, left)]:
        out[k] += 1
    return out


def edf_period(shares: dict) -> dict:
    """Slots of each source's blocks within one period of sum(shares) slots."""
    period = sum(shares.values())
    names = sorted(shares, key=str)
    slots: dict = {k: [] for k in names}
    released: list[list[tuple[int, str]]] = [[] for _ in range(period)]
    for i, k in enumerate(names):
        for j in range(shares[k]):
            deadline = -(-(j + 1) * period // shares[k])
            released[j * period // shares[k]].append((deadline, i))
    due: list[tuple[int, int]] = []
    for t in range(period):
        for block in released[t]:
            heapq.heappush(due, block)
        slots[names[heapq.heappop(due)[1]]].append(t)
    return slots


def phases(blocks: dict, shares: dict) -> list[tuple]:
    """Rows of the schedule: per phase and source the blocks
    ``first .. end - 1`` run in slots base + (j // a) * period + slots[j % a]."""
    used, base, out = dict.fromkeys(blocks, 0), 0, []
    live = {k: shares[k] for k, n in blocks.items() if n}
    while live:
        period, slots = sum(live.values()), edf_period(live)
        span = 1 + min((blocks[k] - used[k] - 1) // a * period + slots[k][(blocks[k] - used[k] - 1) % a]
                       for k, a in live.items())
        for k, a in live.items():
            n = span // period * a + bisect_left(slots[k], span % period)
            if n:
                out.append((k, used[k], used[k] + n, base, period, a, slots[k]))
            used[k] += n
        base += span
        live = {k: a for k, a in live.items() if used[k] < blocks[k]}
    return out


def deal_slots(blocks: Sequence[int], weights: Sequence[float]) -> Iterator[int]:
    """The source (its index) that runs in each slot."""
    ends = sorted((n / w, i) for i, (n, w) in enumerate(zip(blocks, weights, strict=True)) if n)
    live = [0.0]  # weight of the sources that end last, by their number
    for _, i in reversed(ends):
        live.append(live[-1] + weights[i])
    since, v0, gone = 0.0, 0.0, 0
    waiting = [(0.0, i) for _, i in ends]  # (start, source) of the next blocks
    heapq.heapify(waiting)
    ready: list[tuple[float, int]] = []  # (end, source) of those that may run
    done = [0] * len(blocks)
    for at in range(sum(blocks)):
        # virtual time at the slot's end; sources leave when the ideal mix has run them
        while gone < len(ends) - 1 and v0 + (at + 1 - since) / live[len(ends) - gone] >= ends[gone][0]:
            since += (ends[gone][0] - v0) * live[len(ends) - gone]
            v0 = ends[gone][0]
            gone += 1
        v = v0 + (at + 1 - since) / live[len(ends) - gone]
        while waiting and (waiting[0][0] < v or not ready):
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, ((done[i] + 1) / weights[i], i))
        i = heapq.heappop(ready)[1]
        done[i] += 1
        if done[i] < blocks[i]:
            heapq.heappush(waiting, (done[i] / weights[i], i))
        yield i


def _deal(block_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((k, n, w) for b in batches for k, n, w in zip(
            *(c.to_pylist() for c in b.columns), strict=True))
        keys, done = [k for k, _, _ in rows], [0] * len(rows)
        out: list[tuple[int, int, int]] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * 3
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in cols[0]], pa.string()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64())], ["key", "block", "slot"])

        for t, i in enumerate(deal_slots([-(-n // block_docs) for _, n, _ in rows], [w for _, _, w in rows])):
            out.append((i, done[i], t))
            done[i] += 1
            if len(out) == _ROWS:
                yield batch()
        yield batch()
    return run


def mix_sources(docs: DataFrame, *, weights: dict | None = None, doc_id: str = "doc_id",
                source: str = "source", temperature: float = 0.5, block_docs: int = BLOCK_DOCS,
                bucket_docs: int = BUCKET_DOCS, max_sources: int | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``source_block`` (within the source),
    ``mix_slot`` (of the block) and ``mix_position`` (of the document).

    Without ``weights`` a source's target weight is its document count to the
    power ``temperature``.
    """
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in _OUT]
    src = F.col(source).cast("string")
    # null sources get a key of their own, so that keys join as they are dealt
    key = F.coalesce(F.concat(F.lit("s"), src), F.lit("n"))
    counts = cut_lineage(docs.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")))
    if max_sources is not None and len(counts.limit(max_sources + 1).collect()) > max_sources:
        raise ValueError(f"more than {max_sources} sources; group rare ones first")
    if weights is None:
        targets = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    else:
        if any(not w > 0 for w in weights.values()):
            raise ValueError("weights must be positive")
        given = spark.createDataFrame([("n" if k is None else f"s{k}", float(w)) for k, w in weights.items()],
                                      "key string, w double")
        targets = counts.join(given, "key", "left")
        if missing := [r["key"][1:] or None for r in targets.filter("w IS NULL").limit(10).collect()]:
            raise ValueError(f"no target weight for {missing}")
    slots = targets.select("key", "n", "w").repartition(1).mapInArrow(_deal(block_docs), _SLOTS)

    total = counts.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // bucket_docs))
    df = docs.select(*rest, key.alias("__key"), F.xxhash64(doc_id).alias("__hash"))
    # ranges of the unsigned hash, so the buckets follow the order of the hash
    df = df.withColumn("__bucket", F.floor(
        (F.shiftrightunsigned("__hash", 1) / F.lit(float(2 ** 63))) * buckets).cast("long"))
    sizes = df.groupBy("__key", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("__key", "__bucket", "n", (F.sum("n").over(
        Window.partitionBy("__key").orderBy("__bucket")) - F.col("n")).alias("__before"))
    # every bucket with the slots of its blocks, from its first one on
    block = lambda no: F.floor(no / block_docs).cast("long")
    held = before.select("__key", "__bucket", "__before", F.explode(F.sequence(
        block(F.col("__before")), block(F.col("__before") + F.col("n") - 1))).alias("__block"))
    held = (held.join(slots, (held["__key"] == slots["key"]) & (held["__block"] == slots["block"]))
            .groupBy("__key", "__bucket").agg(
                F.first("__before").alias("__before"),
                F.sort_array(F.collect_list(F.struct("block", "slot")))["slot"].alias("__slots")))
    df = df.withColumn("__rank", F.row_number().over(
        Window.partitionBy("__key", "__bucket").orderBy("__hash", doc_id)) - 1)
    df = (df.join(held, ["__key", "__bucket"])
          .withColumn("__no", F.col("__before") + F.col("__rank"))
          .withColumn("source_block", block(F.col("__no"))))
    slot = F.get("__slots", (F.col("source_block") - block(F.col("__before"))).cast("int"))
    return (df.withColumn("mix_slot", slot)
            .withColumn("mix_position", F.col("mix_slot") * block_docs + F.col("__no") % block_docs)
            .select(*rest, *_OUT))


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """Rows range-partitioned and sorted by their place, so files written
    from it hold the mix in order."""
    return mixed.repartitionByRange("mix_position").sortWithinPartitions("mix_position")
