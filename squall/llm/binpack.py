"""Best-fit packing into sequences of several permitted lengths.

Pieces (documents, cut where one exceeds the longest sequence) are placed from
the longest to the shortest, each into the open bin with the least room that
still holds it.  When no open bin holds a piece, every permitted capacity that
does is filled on trial with the waiting pieces that the open bins leave over,
and the one with the least cost per packed token is opened, so all lengths are
optimised jointly; at the end each bin is downsized to the smallest permitted
length that holds its contents.

The pieces are first packed by the tasks that read them, ``chunk`` pieces at a
time in the order they arrive, so memory is bounded whatever the lengths are,
and pieces of one bin stand close together in the input (the order a mixing
stage gave them).  Bins that stay part-filled (over a sixteenth empty) give
their pieces back; those of all tasks are dealt to new tasks, ``chunk`` pieces
each, and packed again, so an input of many small files wastes no more than
one of a few large ones.  Their bins have negative ``bin_chunk`` numbers.  A
lost task packs the same rows again.

Defined cases: a null or empty text has no tokens and is in no bin (one row
with null bin, so no document is lost); a text longer than the longest
sequence becomes consecutive pieces; rows with the same ``doc_id`` are packed
as documents each; a null ``doc_id`` is kept as null; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm.common import WORD, scratch_table, text_or_empty

CAPACITIES = (256, 512, 1024, 2048, 4096)
OPEN_COST = 16
CHUNK = 20_000
_SCHEMA = ("doc_id long, piece int, start long, length int, bin_part int, bin_chunk int, bin_no int, "
           "capacity int, bin_offset int")
_PACKED = _SCHEMA + ", part_filled boolean"


class _Waiting:
    """Waiting pieces by length; the longest one not above a bound is found
    from a bit set of the lengths."""

    def __init__(self, lengths: Sequence[int]):
        self.at: dict[int, list[int]] = defaultdict(list)
        for i in range(len(lengths) - 1, -1, -1):  # first come is popped first
            self.at[lengths[i]].append(i)
        self.mask = 0
        for n in self.at:
            self.mask |= 1 << n

    def longest(self, bound: int) -> int:
        return (self.mask & ((2 << bound) - 1)).bit_length() - 1

    def take(self, n: int) -> int:
        i = self.at[n].pop()
        if not self.at[n]:
            self.mask ^= 1 << n
        return i


def _fill(w: _Waiting, first: int, capacity: int) -> list[int]:
    """Lengths that best-fit would put into a new bin; nothing is taken."""
    out, room, mask, used = [first], capacity - first, w.mask, {first: 1}
    if len(w.at[first]) == 1:
        mask ^= 1 << first
    while room > 0:
        n = (mask & ((2 << room) - 1)).bit_length() - 1
        if n <= 0:
            break
        out.append(n)
        room -= n
        used[n] = used.get(n, 0) + 1
        if used[n] == len(w.at[n]):
            mask ^= 1 << n
    return out


def _cheapest(w: _Waiting, first: int, spare: int, capacities: Sequence[int], open_cost: int) -> int:
    """The capacity with the least cost per token for a bin opened with
    ``first``; ``spare`` tokens wait beyond the room of the open bins."""
    best = None
    for c in capacities:
        if c >= first:
            cost = (c + open_cost) / (first + min(sum(_fill(w, first, c)) - first, max(0, spare)))
            if best is None or cost <= best[0]:  # the longer one on ties
                best = (cost, c)
    return best[1]


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES,
         open_cost: int = OPEN_COST) -> list[tuple[int, list[int]]]:
    """Bins as (capacity, piece numbers in order); lengths are 1 .. max."""
    capacities = sorted(capacities)
    w, bins = _Waiting(lengths), []
    rooms: dict[int, list[int]] = defaultdict(list)  # open bins by the room they have left
    mask, spare = 0, sum(lengths)  # tokens that wait less the room of open bins
    while w.mask:
        n = w.longest(capacities[-1])
        if wide := mask >> n:
            room = n + (wide & -wide).bit_length() - 1
            b = rooms[room].pop()  # the one that came to this room last
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, b = _cheapest(w, n, spare - n, capacities, open_cost), len(bins)
            bins.append([])
            spare -= room
        bins[b].append(w.take(n))
        if room > n:
            rooms[room - n].append(b)
            mask |= 1 << (room - n)
    out = []
    for members in bins:
        total = sum(lengths[i] for i in members)
        out.append((next(c for c in capacities if c >= total), members))
    return out


def _packer(capacities: tuple[int, ...], open_cost: int, chunk: int, again: bool):
    """Packs rows (doc_id, piece, start, length); the first time, the pieces
    of part-filled bins come back without a bin, marked ``part_filled``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, done = TaskContext.get().partitionId(), 0
        none = (None,) * 5

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal done
            out, full = [], [r for r in rows if r[3]]
            for no, (cap, members) in enumerate(pack([r[3] for r in full], capacities, open_cost)):
                if not again and 16 * sum(full[m][3] for m in members) < 15 * cap:
                    out += [(*full[m], *none, True) for m in members]
                    continue
                at = 0
                for m in members:
                    out.append((*full[m], part, -1 - done if again else done, no, cap, at, False))
                    at += full[m][3]
            out += [(*r, *none, False) for r in rows if not r[3]]
            done += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 6, pa.bool_()]
            names = [x.split()[0] for x in _PACKED.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

        held: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(row)
                if len(held) == chunk:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)
    return run


def best_fit_pack(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  capacities: Sequence[int] = CAPACITIES, open_cost: int = OPEN_COST,
                  chunk: int = CHUNK) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece`` (from 0), ``start`` (words
    before it in the document), ``length`` (words), its bin (``bin_part``,
    ``bin_chunk``, ``bin_no``), the bin's ``capacity`` and its ``bin_offset``."""
    capacities = tuple(sorted({int(c) for c in capacities}))
    if not capacities or capacities[0] < 1:
        raise ValueError("capacities must be positive")
    top = capacities[-1]
    n = F.col("n")
    pieces = (docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                          F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("n"))
              .select("doc_id", "n", F.posexplode(F.sequence(
                  F.lit(0).cast("long"), F.greatest(n - 1, F.lit(0)), F.lit(top).cast("long"))).alias("piece", "start"))
              .select("doc_id", "piece", "start", F.least(n - F.col("start"), F.lit(top)).cast("int").alias("length")))
    # written, because the part-filled bins are read once more
    once = scratch_table(pieces.mapInArrow(_packer(capacities, open_cost, chunk, False), _PACKED), "packed")
    placed, left = once.filter("NOT part_filled").drop("part_filled"), once.filter("part_filled")
    tasks = -(-left.count() // chunk)
    if not tasks:
        return placed
    left = left.select(*pieces.columns).repartition(tasks)
    return placed.union(left.mapInArrow(_packer(capacities, open_cost, chunk, True), _PACKED).drop("part_filled"))
