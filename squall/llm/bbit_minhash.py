"""MinHash near-dedup with b-bit signatures.

Every document's shingle set gives ``BANDS * ROWS`` minima.  Band keys are
taken from the whole minima; then only the low ``BITS`` bits of each are kept,
packed as bit planes.  Documents in one band bucket become candidates through
the bucket's smallest and largest id (never all pairs), the similarity of a
candidate pair is estimated from the bit count of its planes, corrected for
chance collisions, and pairs that may reach the threshold are confirmed on
their full shingle sets.

Documents with equal sets are one class from the start, so copies cost one
row.  Links between classes that no bucket centre shows are found exactly
afterwards: related classes (joined by weak estimates) that still lie in
different components are compared set by set, in blocks of bounded size, and
classes that share a bucket without being related are compared by estimate in
the join and then on their sets.  With 32 bands of 4 rows a pair at similarity
0.8 shares no bucket with probability 5e-8, and the estimate of such a pair
falls below the cut with probability 1e-5.

Defined cases: a null or blank text has an empty set and links with nothing;
with fewer words than the shingle size the whole sequence is one shingle;
rows that repeat a ``doc_id`` are one document (any of their texts may link);
a row with a null ``doc_id`` is a document of its own (rows without id and of
equal text are one), known inside by the 64-bit hash of its text: it links like
any other but never names a component, and one without any id has a null
``component_id``; sets are compared by 64-bit shingle hashes; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.common import bounded_batches, cut_lineage

BANDS, ROWS, BITS = 32, 4, 4
MINIMA = BANDS * ROWS
SHINGLE, PERCENT = 5, 80
SLACK = 0.16  # over four standard deviations of an estimate at 0.8
WEAK = 0.5
BLOCK_DOCS = 256
_WORDS_KEPT = 400_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_rng = np.random.default_rng(20240229)
_MIX = _rng.integers(0, 2 ** 64, 64, dtype=np.uint64) | np.uint64(1)
_XOR = _rng.integers(0, 2 ** 64, MINIMA, dtype=np.uint64)
_MUL = _rng.integers(0, 2 ** 64, MINIMA, dtype=np.uint64) | np.uint64(1)
_FEATURES = "node long, doc_id long, n_shingles long, d0 long, d1 long, bands array<long>, sig array<long>"


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    h = columns[0] * _MIX[0]
    for k, c in enumerate(columns[1:], 1):
        h ^= h >> np.uint64(31)
        h = (h + c) * _MIX[k]
    return h ^ (h >> np.uint64(29))


def shingle_set(text: bytes, words: _WordHash, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    ws = text.translate(_LOWER).split()
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter((words[w] for w in ws), np.uint64, len(ws))
    if len(ws) < size:
        return _mixed(list(h[:, None]) + [np.array([len(ws)], np.uint64)])
    return np.unique(_mixed([h[k:len(h) - size + 1 + k] for k in range(size)]))


def minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(MINIMA, 2 ** 64 - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        v = shingles[at:at + 1024, None] ^ _XOR
        v *= _MUL
        np.minimum(low, v.min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    m = low.reshape(BANDS, ROWS)
    return (_mixed([m[:, i] for i in range(ROWS)]) ^ (np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[-1])).view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    """Bit planes of the low bits: plane i holds bit i of all minima."""
    v = low ^ (low >> np.uint64(33))
    planes = (v[None] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8), axis=1).reshape(-1).view(np.int64)


def _features(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHash()
        for b in batches:
            rows = []
            for k, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                s = shingle_set(t.as_py() or b"", words, size)
                if len(s):
                    d = xxhash.xxh3_128_digest(s.tobytes())
                    low = minima(s)
                    rows.append((k, i, len(s), int.from_bytes(d[:8], "little", signed=True),
                                 int.from_bytes(d[8:], "little", signed=True), band_keys(low), packed(low)))
                else:
                    rows.append((k, i, 0, None, None, None, None))
            cols = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2, strict=True)],
                [x.split()[0] for x in _FEATURES.split(", ")])
    return run


def node(doc_id: str, text: str) -> Column:
    """The number by which links know a row: its id, or its text's hash."""
    return F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(F.lit("no id"), F.col(text).cast("string")))


def features(docs: DataFrame, *, doc_id: str, text: str, size: int) -> DataFrame:
    bounded_batches(docs.sparkSession)
    rows = docs.select(node(doc_id, text).alias("node"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(_features(size), _FEATURES)


def estimate(a: Column, b: Column) -> Column:
    """Collision-corrected similarity of two packed signatures."""
    words = MINIMA // 64
    differ = None
    for w in range(words):
        x = a[w].bitwiseXOR(b[w])
        for p in range(1, BITS):
            x = x.bitwiseOR(a[p * words + w].bitwiseXOR(b[p * words + w]))
        differ = F.bit_count(x) if differ is None else differ + F.bit_count(x)
    chance = 2.0 ** -BITS
    return ((MINIMA - differ) / F.lit(float(MINIMA)) - chance) / (1 - chance)


class _Sets(OrderedDict):
    """Shingle sets of the last few texts by id (pairs of a bucket share one)."""

    def __init__(self, size: int, kept: int = 64):
        super().__init__()
        self.size, self.kept, self.words = size, kept, _WordHash()

    def of(self, key, text: bytes) -> np.ndarray:
        if key in self:
            self.move_to_end(key)
            return self[key]
        self[key] = s = shingle_set(text, self.words, self.size)
        if len(self) > self.kept:
            self.popitem(last=False)
        return s


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(size)
        for b in batches:
            out = []
            a_ids, b_ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, (x, y) in enumerate(zip(a_ids, b_ids, strict=True)):
                # the text is part of the key: rows may repeat an id
                tx, ty = b.column(2)[i].as_py(), b.column(3)[i].as_py()
                p = sets.of((x, xxhash.xxh3_64_intdigest(tx)), tx)
                q = sets.of((y, xxhash.xxh3_64_intdigest(ty)), ty)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    out.append((x, y))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], pa.int64()) for k in range(2)], ["a", "b"])
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    t = texts.select("rep", "t")
    joined = (pairs.select("a", "b").join(t.withColumnsRenamed({"rep": "a", "t": "ta"}), "a")
              .join(t.withColumnsRenamed({"rep": "b", "t": "tb"}), "b"))
    return joined.select("a", "b", "ta", "tb").mapInArrow(_confirm(size, percent), "a long, b long")


def _block_links(size: int, percent: int):
    """Links between different components within a pair of blocks, at most
    one for each pair of components that are not joined already."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHash()
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1), strict=True):
                items = [(r["comp"], shingle_set(r["t"], words, size)) for r in left.as_py()]
                n = len(items)
                items += [(r["comp"], shingle_set(r["t"], words, size)) for r in right.as_py()]
                root: dict[int, int] = {}

                def find(x: int) -> int:
                    while root.get(x, x) != x:
                        x = root[x]
                    return x

                lens = np.array([len(s) for _, s in items])
                _, code = np.unique(np.concatenate([s for _, s in items]), return_inverse=True)
                ends = np.cumsum(lens)
                comp = np.array([c for c, _ in items])
                base = ends[n - 1] if n else 0
                mark = np.zeros(int(code.max()) + 1, np.int64)
                out = []
                for i in range(n):
                    own = code[ends[i] - lens[i]:ends[i]]
                    mark[own] = 1
                    both = np.add.reduceat(mark[code[base:]], ends[n:] - lens[n:] - base)
                    mark[own] = 0
                    near = 100 * both >= percent * (lens[i] + lens[n:] - both)
                    for j in np.flatnonzero(near & (comp[n:] != comp[i])):
                        x, y = find(int(comp[i])), find(int(comp[n + j]))
                        if x != y:
                            root[max(x, y)] = min(x, y)
                            out.append((int(comp[i]), int(comp[n + j])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[k] for o in out], pa.int64()) for k in range(2)], ["a", "b"])
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over undirected (a, b).

    Labels spread to neighbours and jump to their label's label, so chains
    shorten by half and more in each round; every round is one checkpoint.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    label = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(label, both["b"] == label["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        step = label.join(near, label["node"] == near["a"]).select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = label.select(F.col("node").alias("up"), F.col("comp").alias("top"))
        step = cut_lineage(step.join(up, step["comp"] == up["up"], "left").select(
            "node", "old", F.least("comp", F.coalesce("top", "comp")).alias("comp")))
        label = step.select("node", "comp")
        if step.filter("old <> comp").isEmpty():
            return label


def _blocked(related: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between the components of each related group, set by set.

    related: (rep, comp, grp) of groups with several components.  A component
    with more than a block of members has blocks of its own, which are not
    compared with each other; smaller ones share blocks.
    """
    sizes = related.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < BLOCK_DOCS // 2
    total = (sizes.filter(small).groupBy("grp").agg(F.sum("n").alias("n_small")))
    sizes = sizes.join(total, "grp", "left")
    rows = related.join(sizes, ["grp", "comp"]).withColumn(
        "own", F.when(~small, F.col("comp"))).withColumn(
        "block", F.when(small, F.pmod(F.xxhash64("comp"), F.ceil(F.col("n_small") / BLOCK_DOCS * 2)))
        .otherwise(F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / BLOCK_DOCS * 2))))
    blocks = (rows.join(texts.select("rep", "t"), "rep")
              .groupBy("grp", "own", "block").agg(F.collect_list(F.struct("comp", "t")).alias("items")))
    blocks = cut_lineage(blocks.withColumn("no", F.struct(F.coalesce("own", F.lit(-1).cast("long")).alias("own"), "block")))
    a, b = blocks.alias("a"), blocks.alias("b")
    pairs = a.join(b, (F.col("a.grp") == F.col("b.grp")) & (F.col("a.no") <= F.col("b.no"))
                   & ~F.coalesce(F.col("a.own") == F.col("b.own"), F.lit(False)))
    return pairs.select(F.col("a.items").alias("x"), F.col("b.items").alias("y")).mapInArrow(
        _block_links(size, percent), "a long, b long")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``
    (smallest id reachable over links) and ``kept`` (it is its own)."""
    cut = percent / 100 - SLACK
    bounded_batches(docs.sparkSession)
    f = cut_lineage(features(docs, doc_id=doc_id, text=text, size=shingle))
    classes = (f.filter("n_shingles > 0").groupBy("d0", "d1")
               .agg(F.coalesce(F.min("doc_id"), F.min("node")).alias("rep"), F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.first("sig").alias("sig")))
    reps = classes = cut_lineage(classes)
    # band buckets, their two centres, and the members' pairs with them
    members = reps.select("rep", F.explode("bands").alias("key"))
    centres = (members.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
               .filter("lo < hi"))
    star = (members.join(centres, "key")
            .select("rep", F.explode(F.array("lo", "hi")).alias("c")).filter("rep <> c")
            .select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")).distinct())
    star = cut_lineage(star)
    known = star.select(F.col("a").alias("rep")).union(star.select("b")).distinct()
    rows = docs.select(node(doc_id, text).alias("rep"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("t"))
    texts = cut_lineage(rows.join(known, "rep"))
    sigs = cut_lineage(reps.select("rep", "sig", "bands").join(known, "rep"))
    s = sigs.select("rep", "sig")
    scored = (star.join(s.withColumnsRenamed({"rep": "a", "sig": "sa"}), "a")
              .join(s.withColumnsRenamed({"rep": "b", "sig": "sb"}), "b")
              .select("a", "b", estimate(F.col("sa"), F.col("sb")).alias("est")))
    scored = cut_lineage(scored.groupBy("a", "b").agg(F.max("est").alias("est")).filter(F.col("est") >= WEAK))
    links = cut_lineage(confirmed(scored.filter(F.col("est") >= cut), texts, shingle, percent))
    # related classes, and what the confirmed links make of them
    comp, grp = components(links), components(scored)
    state = cut_lineage(known.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                        .join(grp.select(F.col("node").alias("rep"), F.col("comp").alias("grp")), "rep", "left")
                        .select("rep", F.coalesce("comp", "rep").alias("comp"), F.coalesce("grp", "rep").alias("grp")))
    open_groups = state.groupBy("grp").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("grp")
    within = _blocked(state.join(open_groups, "grp"), texts, shingle, percent)
    # classes in one bucket that are not related by any centre
    placed = sigs.select("rep", "sig", "bands", F.posexplode("bands").alias("no", "key")).join(state.select("rep", "grp"), "rep")
    mixed = placed.groupBy("key").agg(F.min("grp").alias("x"), F.max("grp").alias("y")).filter("x <> y").select("key")
    placed = cut_lineage(placed.join(mixed, "key").select("key", "no", "rep", "grp", "sig", "bands"))
    p, q = placed.alias("p"), placed.alias("q")
    first = F.array_position(F.zip_with("p.bands", "q.bands", lambda x, y: x == y), F.lit(True)) == F.col("p.no") + 1
    across = p.join(q, (F.col("p.key") == F.col("q.key")) & (F.col("p.rep") < F.col("q.rep"))
                    & (F.col("p.grp") != F.col("q.grp"))
                    & (estimate(F.col("p.sig"), F.col("q.sig")) >= cut) & first)
    across = confirmed(across.select(F.col("p.rep").alias("a"), F.col("q.rep").alias("b")), texts, shingle, percent)
    # links between components on top of those inside them
    final = components(links.union(within).union(across))
    # the node that names a component inside may be a hash: its smallest id counts
    final = final.withColumnRenamed("node", "rep")
    least = final.join(classes.select("rep", "id"), "rep").groupBy("comp").agg(F.min("id").alias("least"))
    named = classes.select("d0", "d1", "id", "rep").join(final.join(least, "comp"), "rep", "left").select(
        "d0", "d1", F.coalesce("least", "id").alias("comp"))
    out = f.select("doc_id", "n_shingles", "d0", "d1").join(named, ["d0", "d1"], "left")
    component = F.when(F.col("d0").isNull(), F.col("doc_id")).otherwise(F.col("comp"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
