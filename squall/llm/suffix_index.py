"""Suffix-array dedup with a logarithmic index family.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.  The suffixes of a batch are sampled: every
window of ``LENGTH`` bytes has an anchor, the ``GRAM`` bytes in it with the
least hash, so equal windows have equal anchors; consecutive windows with one
anchor form a run, the unit of a match.  A batch's array holds the anchors of
its runs in sorted order (by 64-bit fingerprint, the order in which arrays
are merged); it becomes a level of the index, and levels of equal size merge,
so a shard with n entries has log n levels and every entry is merged log n
times.  Of equal runs that meet in a merge, those of later documents leave as
repeats, in whatever order the batches come.

1. Tasks cut texts into runs.  A run that the task's batch holds already in
   an earlier document is a repeat; the others go to the shard of their
   anchor, packed column by column in one row per batch and shard.  An anchor
   with more runs than a shard gets from the batch on the average is hot, and
   one entry tells the shard so: however often an anchor occurs, no shard
   fills with it.
2. A shard's index tells a run whose anchor came with the same run in an
   earlier document (a repeat: all its windows are) from one whose anchor came
   with another run that may share a window with it (contested).  A window
   reaches ``half = (LENGTH - GRAM) // 2`` bytes or more beyond its anchor to
   the left or to the right, so two runs that share one have equal bytes from
   ``half`` before the anchor to its end, or from its start to ``half`` after
   it; 16 bits of the hash of either side travel with the run.  A run in which
   the anchor stands more than once has no such sides: all runs of its anchor
   are contested.
3. Contested runs are decided window by window through the same index, in the
   shard of their anchor; those of a hot anchor and of one with more than
   ``HOT`` of them go window by window to the shard of the window instead, the
   first of each batch only.
4. The repeats of a document are united into spans and cut out.

Document texts meet their runs in equi-joins on the id.  Literal suffix order
would move ``LENGTH`` bytes per suffix; a packed run moves about eighteen.
Runs are compared by 96 bits (anchor and fingerprint), windows by 64; equal
sides of different runs only lead to the comparison of their windows.  The
shuffle files of the runs are deleted before the texts are shuffled.

Defined cases: a null text is empty; documents shorter than ``LENGTH`` bytes
lose nothing; rows that repeat a ``doc_id`` are one document for the
comparison (they do not repeat each other) and each has its own result; a null
``doc_id`` is smaller than none and larger than all: its row is compared with
every other document but removes nothing from it; a text of more than
``BATCH_BYTES`` is cut in overlapping pieces of that size; an empty table gives
an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm.common import bounded_batches, scratch_table, shuffle_parts

LENGTH, GRAM = 50, 16
BATCH_BYTES = 1 << 20
HOT = 4096
BATCH_RUNS, INDEX_RUNS = 400_000, 200_000
NO_ID = (1 << 63) - 1  # stands for a null id: after all others
_OUT = ["n_bytes", "n_removed", "n_spans", "kept_bytes"]

REPEAT, RUN, CONTESTED, HOTLY = 0, 1, 2, 3  # kinds; HOTLY: contested, of a hot anchor
_LOOSE = np.uint16(1 << 15)  # in n: the anchor stands more than once in the run

_rng = np.random.default_rng(31337)
_BYTE = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
_STEP = _rng.integers(0, 2 ** 64, 16, dtype=np.uint64) | np.uint64(1)
_S29, _S32 = np.uint64(29), np.uint64(32)


class _Grams:
    """Hashes of all strings of 1, 2, 4 .. bytes of a buffer, and of any
    length from those."""

    def __init__(self, data: np.ndarray, longest: int):
        self.by = {1: _BYTE[data]}
        n = 1
        while 2 * n <= longest:
            h = self.by[n]
            g = h[:-n] * _STEP[n.bit_length()]
            g += h[n:]
            g ^= g >> _S29
            self.by[2 * n] = g
            n *= 2

    def of(self, length: int) -> np.ndarray:
        out, at = None, 0
        for n in sorted(self.by, reverse=True):
            if length & n:
                h = self.by[n]
                if out is None:
                    out = h
                else:
                    m = min(len(out), len(h) - at)
                    out = out[:m] * _STEP[15] + h[at:at + m]
                    out ^= out >> _S32
                at += n
        return out


    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        """``of(length)`` at some places."""
        out, at = None, 0
        for n in sorted(self.by, reverse=True):
            if length & n:
                h = self.by[n][places + at]
                if out is None:
                    out = h
                else:
                    out = out * _STEP[15] + h
                    out ^= out >> _S32
                at += n
        return out


def _least(h: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` consecutive values."""
    n = 1
    while 2 * n <= span:
        h = np.minimum(h[:-n], h[n:])
        n *= 2
    return np.minimum(h[:len(h) - (span - n)], h[span - n:]) if span > n else h


def windows(data: np.ndarray, length: int) -> np.ndarray:
    return _Grams(data, length).of(length)


def runs(data: np.ndarray, lens: np.ndarray, length: int, gram: int):
    """(document, first window, windows, anchor, fingerprint) of every run of
    documents laid end to end.  Windows never cross documents."""
    return _sided_runs(data, lens, length, gram)[:5]


def _sided_runs(data: np.ndarray, lens: np.ndarray, length: int, gram: int):
    """``runs`` with the codes of their sides and whether the anchor stands
    more than once in them."""
    empty = np.empty(0, np.int64)
    none = empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64), empty.astype(np.uint32), empty.astype(bool)
    if len(data) < length:
        return none
    g = _Grams(data, length)
    grams = g.of(gram)
    low = _least(grams, length - gram + 1)
    win = g.of(length)
    ends = np.cumsum(lens)
    doc = np.repeat(np.arange(len(lens)), lens)[:len(win)]
    inside = np.arange(len(win)) + length <= ends[doc]
    at = np.flatnonzero(inside)
    low, win, doc = low[at], win[at], doc[at]
    if not len(at):
        return none
    new = np.empty(len(at), bool)
    new[0] = True
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    # a periodic text may go on with one anchor: cut such runs so that the two
    # end windows always cover all their bytes
    most = length - gram + 1
    if (n > most).any():
        parts = -(-n // most)
        start = np.repeat(first, parts)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        stop = np.minimum(start + (nth + 1) * most, np.repeat(first + n, parts))
        first = start + nth * most
        n = stop - first
    last = first + n - 1
    key = win[first] * _STEP[13] + win[last]
    key ^= key >> _S29
    key = key * _STEP[14] + n.astype(np.uint64)
    key ^= key >> _S32
    sides, loose = _sides(g, grams, at[first], n, length, gram)
    return doc[first], at[first] - (ends - lens)[doc[first]], n, low[first], key, sides, loose


def _sides(g: _Grams, grams: np.ndarray, start: np.ndarray, n: np.ndarray, length: int, gram: int):
    """(16 bits of the hash of the bytes up to the anchor's end, and of those
    from its start; 0 where no window of the run holds them; the anchor stands
    more than once)."""
    span = length - gram + 1
    half = (span - 1) // 2
    stop = start + n - 1
    place, loose = np.empty(len(start), np.int64), np.empty(len(start), bool)
    view = np.lib.stride_tricks.sliding_window_view(grams, span)
    for i in range(0, len(start), 16_384):
        j = slice(i, i + 16_384)
        place[j] = start[j] + view[start[j]].argmin(1)
        loose[j] = place[j] != stop[j] + span - 1 - view[stop[j], ::-1].argmin(1)
    out = np.zeros(len(start), np.uint32)
    for shift, back, has in ((0, half, place - start >= half), (16, 0, place - stop <= span - 1 - half)):
        i = np.flatnonzero(has & ~loose)
        code = (g.at(place[i] - back, gram + half) >> np.uint64(48)).astype(np.uint32)
        out[i] |= np.maximum(code, np.uint32(1)) << np.uint32(shift)
    return out, loose


class LogIndex:
    """Fingerprint -> what came first, in sorted levels whose sizes fall
    geometrically."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def scan(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, value) of the sorted batch ``keys`` by merge scan."""
        known, found = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        for own, values in self.levels:
            at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            hit = own[at] == keys
            known |= hit
            found[hit] = values[at[hit]]
        return known, found

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """A new level of sorted keys; levels of its size merge into it."""
        if not len(keys):
            return
        while self.levels and len(self.levels[-1][0]) <= 2 * len(keys):
            own, old = self.levels.pop()
            both = np.concatenate([own, keys])
            order = np.argsort(both, kind="stable")
            keys, values = both[order], np.concatenate([old, values])[order]
        self.levels.append((keys, values))


# ``mark`` tells rows that repeat an id apart (a hash of the text, 0 if ids are unique)
_DEALT = "shard int, kind int, rows binary"
_HIT = "kind int, deal int, doc long, mark long, at int, n int"
_PART = "kind int, shard long, doc long, mark long, at int, n int, data binary"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _record(schema: str, columns: list) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(np.asarray(c), _KINDS[t])
         for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _records(schema: str, columns: list, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    b = _record(schema, columns)
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)


def _columns(b: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in b.columns]


def _by_bytes(batches: Iterator[pa.RecordBatch], text: int, limit: int) -> Iterator[list[list]]:
    """Columns as lists, about ``limit`` bytes of column ``text`` at a time."""
    held, size = None, 0
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            held = held or [[] for _ in row]
            for h, v in zip(held, row, strict=True):
                h.append(v)
            size += len(row[text])
            if size >= limit:
                yield held
                held, size = None, 0
    if held:
        yield held


def _pieces(batches: Iterator[pa.RecordBatch], length: int, limit: int) -> Iterator[tuple[list, list, np.ndarray, list]]:
    """Batches of (ids, marks, offsets, texts); a text above ``limit`` comes in
    pieces that overlap by all but one byte of a window."""
    for ids, marks, texts in _by_bytes(batches, 2, limit):
        short = [i for i, t in enumerate(texts) if len(t) <= limit]
        if short:
            yield [ids[i] for i in short], [marks[i] for i in short], np.zeros(len(short), np.int64), [texts[i] for i in short]
        for i, t in enumerate(texts):
            if len(t) > limit:
                for at in range(0, len(t) - length + 1, limit):
                    yield [ids[i]], [marks[i]], np.array([at]), [t[at:at + limit + length - 1]]


def _spread(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A shard for rows that only pass through."""
    return (doc.astype(np.uint64) * _STEP[0] + at.astype(np.uint64)).view(np.int64)


def _changes(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the row before."""
    new = np.ones(len(sorted_columns[0]), bool)
    new[1:] = False
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _groups(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each group, group of each row)."""
    return np.flatnonzero(new), np.cumsum(new) - 1


# columns of runs in the index (n 0: the anchor is hot) and of decided rows
_ENTRY = [np.dtype(t) for t in ("u8", "u4", "u4", "i8", "i8", "i4", "u2")]  # anchor, key, sides, doc, mark, at, n
_DECIDED = [np.dtype(t) for t in ("i4", "i8", "i8", "i4", "i4")]  # deal, doc, mark, at, n


def _pack(columns: list[np.ndarray], kinds: list[np.dtype]) -> bytes:
    """Rows as planes of bytes, which compress well; the first column as its
    differences."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    return b"".join(np.ascontiguousarray(c, t).view(np.uint8).reshape(-1, t.itemsize).T.tobytes()
                    for c, t in zip([first, *columns[1:]], kinds, strict=True))


def _unpack(data: bytes, kinds: list[np.dtype]) -> list[np.ndarray]:
    rows = len(data) // sum(t.itemsize for t in kinds)
    out, at = [], 0
    for t in kinds:
        planes = np.frombuffer(data, np.uint8, rows * t.itemsize, at).reshape(t.itemsize, rows)
        out.append(np.ascontiguousarray(planes.T).view(t).ravel())
        at += rows * t.itemsize
    return [np.cumsum(out[0], dtype=kinds[0]), *out[1:]]


def _by_run(anchor: np.ndarray, key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Order by anchor, key and document."""
    order = np.argsort(anchor, kind="stable")
    a = anchor[order]
    again = np.zeros(len(a), bool)
    again[1:] = a[1:] == a[:-1]
    again[:-1] |= again[1:]
    at = np.flatnonzero(again)
    rows = order[at]
    order[at] = rows[np.lexsort((doc[rows], key[rows], anchor[rows]))]
    return order


def _cut(length: int, gram: int, limit: int, parts: int, hot: int):
    """Rows (doc, mark, text) to packed runs for each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, texts_so_far = [], 0, 0
        for ids, marks, starts, texts in _pieces(batches, length, limit):
            lens = np.array([len(t) for t in texts], np.int64)
            row, at, n, anchor, key, sides, loose = _sided_runs(
                np.frombuffer(b"".join(texts), np.uint8), lens, length, gram)
            n = n.astype(np.uint16) | np.where(loose, _LOOSE, np.uint16(0))
            held.append([anchor * _STEP[1], np.maximum(key.astype(np.uint32), np.uint32(1)), sides, np.array(ids, np.int64)[row],
                         np.array(marks, np.int64)[row], (at + starts[row]).astype(np.int32), n, row + texts_so_far])
            rows, texts_so_far = rows + len(row), texts_so_far + len(texts)
            if rows >= BATCH_RUNS:
                yield from _deal([np.concatenate(c) for c in zip(*held, strict=True)], parts, hot)
                held, rows = [], 0
        if rows:
            yield from _deal([np.concatenate(c) for c in zip(*held, strict=True)], parts, hot)
    return run


def _windows_in(n: np.ndarray) -> np.ndarray:
    return (n & ~_LOOSE).astype(np.int32)


def _deal(columns: list[np.ndarray], parts: int, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of a batch (columns of the index, and the text each is of) to
    packed rows; most: runs of an anchor that is not hot."""
    order = _by_run(columns[0], columns[1], columns[3])
    anchor, key, sides, doc, mark, at, n, row = (c[order] for c in columns)
    heads, grp = _groups(_changes(anchor, key))
    later = doc > doc[heads][grp]
    # repeats that follow one another are one
    r = np.flatnonzero(later)
    r = r[np.lexsort((at[r], row[r]))]
    size = _windows_in(n[r])
    gap = _changes(row[r])
    gap[1:] |= at[r][1:] != (at[r] + size)[:-1]
    h, g = _groups(gap)
    sizes = np.bincount(g, size).astype(np.int32)
    yield from _passing(REPEAT, [np.zeros(len(h), np.int32), doc[r][h], mark[r][h], at[r][h], sizes], parts)
    anchor, key, sides, doc, mark, at, n = (c[~later] for c in (anchor, key, sides, doc, mark, at, n))
    heads, grp = _groups(_changes(anchor))
    over = np.bincount(grp) > min(most, max(16, len(order) // parts))
    hot = over[grp]
    yield from _passing(HOTLY, [np.zeros(hot.sum(), np.int32), doc[hot], mark[hot], at[hot], _windows_in(n[hot])], parts)
    told = heads[over]
    key[told] = sides[told] = n[told] = 0
    hot[told] = False
    entries = [c[~hot] for c in (anchor, key, sides, doc, mark, at, n)]
    shard = (entries[0] >> _S32) * np.uint64(parts) >> _S32
    ends = np.searchsorted(shard, np.arange(parts + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(ends))
    for i in range(0, len(full), 64):
        some = full[i:i + 64]
        yield _record(_DEALT, [some, np.full(len(some), RUN),
                               pa.array([_pack([c[ends[k]:ends[k + 1]] for c in entries], _ENTRY) for k in some], pa.binary())])


def _passing(kind: int, columns: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """Decided rows, dealt over all shards alike."""
    rows = len(columns[0])
    if not rows:
        return
    step = max(256, -(-rows // parts))
    starts = np.arange(0, rows, step)
    first = int(_spread(columns[1][:1], columns[3][:1])[0]) % parts
    for i in range(0, len(starts), 64):
        some = starts[i:i + 64]
        yield _record(_DEALT, [(first + some // step) % parts, np.full(len(some), kind),
                               pa.array([_pack([c[k:k + step] for c in columns], _DECIDED) for k in some], pa.binary())])


class RunIndex:
    """Runs in sorted levels whose sizes fall geometrically.  Where levels
    merge, a run that an earlier document has leaves as a repeat."""

    def __init__(self):
        self.levels: list[list[np.ndarray]] = []

    @staticmethod
    def _merge(levels: list[list[np.ndarray]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(entries that stay, (deal, doc, mark, at, n) of the repeats).  Uses
        up ``levels``: column by column, to hold little more than one copy."""
        both = []
        for k in range(len(_ENTRY)):
            both.append(np.concatenate([x[k] for x in levels]))
            for x in levels:
                x[k] = None
        order = _by_run(both[0], both[1], both[3])
        for k in range(len(both)):
            both[k] = both[k][order]
        heads, grp = _groups(_changes(both[0], both[1]))
        later = both[3] > both[3][heads][grp]
        gone = later & (both[6] > 0)
        doc, mark, at, n = (c[gone] for c in both[3:])
        for k in range(len(both)):
            both[k] = both[k][~later]
        return both, [np.zeros(len(doc), np.int32), doc, mark, at, _windows_in(n)]

    def add(self, levels: list[list[np.ndarray]]) -> list[np.ndarray]:
        size = sum(len(x[0]) for x in levels)
        while self.levels and len(self.levels[-1][0]) <= 2 * size:
            levels = [self.levels.pop(), *levels]
            size += len(levels[0][0])
        kept, repeats_ = self._merge(levels)
        self.levels.append(kept)
        return repeats_

    def whole(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """All levels as one, and the last repeats."""
        levels, self.levels = self.levels, []
        return self._merge(levels)


def _contested(entries: list[np.ndarray], hot: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(kind, rows) of the runs that may share a window with another document's
    other run of their anchor."""
    anchor, key, sides, doc, mark, at, n = entries
    heads, grp = _groups(_changes(anchor))
    told = np.bincount(grp, n == 0) > 0
    several = np.bincount(grp, _changes(anchor, key)) > 1
    rows = np.flatnonzero(several[grp])
    of, d = grp[rows], doc[rows]
    open_ = told[of]
    loose = np.zeros(len(heads), bool)
    loose[of[n[rows] >= _LOOSE]] = True
    codes = [(loose[of], of)]
    for shift in (0, 16):
        code = (sides[rows] >> np.uint32(shift) & np.uint32(0xFFFF)).astype(np.int64)
        codes.append((code > 0, of << 16 | code))
    for has, code in codes:
        i = np.flatnonzero(has)
        i = i[np.argsort(code[i], kind="stable")]
        if len(i):
            first, g = _groups(_changes(code[i]))
            open_[i] |= (np.minimum.reduceat(d[i], first) < np.maximum.reduceat(d[i], first))[g]
    rows = rows[open_ & (n[rows] > 0)]
    hotly = (told | (np.bincount(grp[rows], minlength=len(heads)) > hot))[grp[rows]]
    for kind, some in ((CONTESTED, rows[~hotly]), (HOTLY, rows[hotly])):
        deal = (anchor[some] >> _S32).astype(np.uint32).view(np.int32)
        yield kind, [deal, doc[some], mark[some], at[some], _windows_in(n[some])]


def _match_runs(hot: int):
    """Packed rows of one or more shards to repeats and contested runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held, rows = RunIndex(), [], 0

        def hits(kind: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            yield from _records(_HIT, [np.full(len(columns[0]), kind), *columns])

        for b in batches:
            for kind, data in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                if kind != RUN:
                    yield from hits(kind, _unpack(data.as_py(), _DECIDED))
                    continue
                held.append(_unpack(data.as_py(), _ENTRY))
                rows += len(held[-1][0])
                if rows >= INDEX_RUNS:
                    yield from hits(REPEAT, index.add(held))
                    held, rows = [], 0
        if held:
            yield from hits(REPEAT, index.add(held))
        if index.levels:
            entries, repeats_ = index.whole()
            yield from hits(REPEAT, repeats_)
            for kind, columns in _contested(entries, hot):
                yield from hits(kind, columns)
    return run


def _parts(length: int, limit: int):
    """Rows (doc, mark, text, contested runs) to runs with their bytes; runs of
    hot anchors window by window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, marks, texts, lists in _by_bytes(batches, 2, limit):
            cold, hot = [], []
            for d, m, t, found in zip(ids, marks, texts, lists, strict=True):
                for r in found:
                    part = t[r["at"]:r["at"] + r["n"] + length - 1]
                    if r["kind"] == HOTLY:
                        hot.append((d, m, r["at"], part))
                    else:
                        cold.append((RUN, r["deal"], d, m, r["at"], r["n"], part))
            if cold:
                yield from _records(_PART, [pa.array(c, _KINDS[f.split()[1]]) for c, f in
                                            zip(zip(*cold, strict=True), _PART.split(", "), strict=True)], 20_000)
            if hot:
                win, src, at = _windows_of([h[3] for h in hot], length)
                doc = np.array([h[0] for h in hot], np.int64)[src]
                mark, at = np.array([h[1] for h in hot], np.int64)[src], at + np.array([h[2] for h in hot], np.int64)[src]
                order = np.lexsort((at, doc, win))
                heads, grp = _groups(_changes(win[order]))
                first = doc[order][heads][grp]
                again = doc[order] > first
                # the shard of a window is its fingerprint: no bytes need to travel
                for kind, r, shard in ((REPEAT, order[again], _spread(doc, at)), (RUN, order[~again], win)):
                    yield from _records(_PART, [np.full(len(r), kind), shard[r], doc[r], mark[r], at[r], np.ones(len(r), np.int64),
                                                pa.nulls(len(r), pa.binary())])
    return run


def _windows_of(parts: list[bytes], length: int):
    """(fingerprint, part, offset in the part) of all windows of all parts."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    lens = np.array([len(p) for p in parts], np.int64)
    win = windows(data, length).view(np.int64)
    starts = np.cumsum(lens) - lens
    src = np.repeat(np.arange(len(parts)), lens)[:len(win)]
    at = np.flatnonzero(np.arange(len(win)) + length <= (starts + lens)[src])
    return win[at], src[at], at - starts[src[at]]


def _match_windows(length: int):
    """Runs with their bytes and single windows without, in ascending document
    order, to repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LogIndex()
        for b in batches:
            kind, shard, doc, mark, at, n = _columns(b)[:6]
            go = kind == REPEAT
            yield from _records(_HIT, [kind[go], np.zeros(go.sum(), np.int32), doc[go], mark[go], at[go], n[go]])
            bare = b.column(6).is_null().to_numpy(zero_copy_only=False)
            rows, lone = np.flatnonzero(~go & ~bare), np.flatnonzero(~go & bare)
            win, src, off = shard[lone], lone, np.zeros(len(lone), np.int64)
            if len(rows):
                w, s, o = _windows_of(b.column(6).take(pa.array(rows)).to_pylist(), length)
                win, src, off = np.append(win, w), np.append(src, rows[s]), np.append(off, o)
            if not len(win):
                continue
            order = np.lexsort((doc[src], win))
            win, src, off = win[order], src[order], off[order]
            heads, grp = _groups(_changes(win))
            had, first_doc = index.scan(win[heads])
            first_doc[~had] = doc[src][heads[~had]]
            index.add(win[heads[~had]], first_doc[~had])
            hit = np.flatnonzero(doc[src] > first_doc[grp])
            hit = hit[np.lexsort((off[hit], src[hit]))]
            if len(hit):
                s, o = src[hit], off[hit]
                gap = _changes(s)
                gap[1:] |= o[1:] != o[:-1] + 1
                h, g = _groups(gap)
                yield from _records(_HIT, [np.full(len(h), REPEAT), np.zeros(len(h), np.int32), doc[s][h], mark[s][h],
                                           at[s][h] + o[h], np.bincount(g)])
    return run


_SPANS = "n_bytes long, n_removed long, n_spans long, kept_bytes binary"


def _remove(length: int, keep: int):
    """Rows (kept columns, text, repeats) to the text without its repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column(keep).to_pylist()]
            lens = np.array([len(t) for t in texts], np.int64)
            base = np.cumsum(lens + 1) - lens - 1  # texts end to end, one byte apart
            found = b.column(keep + 1)
            doc = np.repeat(np.arange(len(texts)), pc.list_value_length(found).fill_null(0).to_numpy())
            at, n = (found.flatten().field(c).to_numpy().astype(np.int64) for c in ("at", "n"))
            order = np.argsort(base[doc] + at, kind="stable")
            start = (base[doc] + at)[order]
            reach = np.maximum.accumulate(start + n[order] + length - 1)
            new = np.ones(len(start), bool)
            new[1:] = start[1:] > reach[:-1]
            first = np.flatnonzero(new)
            doc = doc[order][first]
            starts, stops = start[first] - base[doc], reach[np.append(first[1:], len(start))[:len(first)] - 1] - base[doc]
            spans = np.bincount(doc, minlength=len(texts))
            gone = np.bincount(doc, stops - starts, len(texts)).astype(np.int64)
            starts, stops, at = starts.tolist(), stops.tolist(), [0, *np.cumsum(spans).tolist()]
            kept = [b"".join(t[x:y] for x, y in zip([0, *stops[i:j]], [*starts[i:j], len(t)], strict=True)) if i < j else t
                    for t, i, j in zip(texts, at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:keep], pa.array(lens), pa.array(gone), pa.array(spans.astype(np.int64)), pa.array(kept, pa.binary())],
                [*b.schema.names[:keep], *_OUT])
    return run


def repeats(docs: DataFrame, keys: list[str], *, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc, mark, at, n): runs of n windows from byte ``at`` that also start
    in an earlier document.  docs: ``keys`` (doc, and mark unless the ids are
    unique) and t."""
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    mark = F.col("mark") if "mark" in keys else F.lit(0).cast("long").alias("mark")
    found = docs.filter(F.octet_length("t") >= length).select("doc", mark, "t").mapInArrow(
        _cut(length, gram, BATCH_BYTES, parts, hot), _DEALT)
    # (by hash before Spark 4.1: several shards may meet in one task)
    found = found.repartitionById(parts, "shard") if hasattr(found, "repartitionById") else found.repartition(parts, "shard")
    found = scratch_table(found.mapInArrow(_match_runs(hot), _HIT), "suffix-runs", free_shuffles=True)
    open_ = (found.filter(F.col("kind") != REPEAT).groupBy(*keys)
             .agg(F.collect_list(F.struct("deal", "kind", "at", "n")).alias("runs")))
    texts = docs.join(open_, keys).select("doc", mark, "t", "runs")
    pieces = texts.mapInArrow(_parts(length, BATCH_BYTES), _PART).repartition(parts, "shard").sortWithinPartitions("doc")
    late = pieces.mapInArrow(_match_windows(length), _HIT)
    cols = ["doc", "mark", "at", "n"]
    return found.filter(F.col("kind") == REPEAT).select(*cols).unionByName(late.select(*cols))


def suffix_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 gram: int = GRAM, hot: int = HOT, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all by default) plus ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``kept_bytes``."""
    bounded_batches(docs.sparkSession)
    rest = [c for c in (docs.columns if columns is None else columns) if c not in _OUT]
    kinds = dict(docs.dtypes)
    unique = (docs.groupBy(F.col(doc_id).alias("id")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty())
    keys = ["doc"] if unique else ["doc", "mark"]
    utf8 = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    own = {f"c{i}": c for i, c in enumerate(rest) if c != doc_id}
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"), utf8.alias("t"),
                        *([] if unique else [F.xxhash64(utf8).alias("mark")]),
                        *[F.col(c).alias(k) for k, c in own.items()])
    gone = (repeats(keyed.select(*keys, "t"), keys, length=length, gram=gram, hot=hot).groupBy(*keys)
            .agg(F.collect_list(F.struct("at", "n")).alias("gone")))
    joined = keyed.join(gone, keys, "left").select("doc", *own, "t", "gone")
    schema = ", ".join(["doc long", *(f"{k} {kinds[c]}" for k, c in own.items()), _SPANS])
    out = joined.mapInArrow(_remove(length, 1 + len(own)), schema)
    name = {c: k for k, c in own.items()}
    back = F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kinds[doc_id]).alias(doc_id)
    return out.select(*[back if c == doc_id else F.col(name[c]).alias(c) for c in rest], *_OUT)
