"""Conversation prefix trie by the Euler-tour technique.

Conversations are rebuilt on the opening turns of their hundred's first one.
Every distinct sequence of first turns is a node; its members are the
conversations that start with it.  Nodes are known by their depth and by two
64-bit folds of their turns' digests and places, which come from a scan of
every conversation in blocks; a node's name is its smallest member.

The tour: every node has an enter and an exit arc.  ``enter`` leads to the
first child's ``enter`` or, without children, to the node's ``exit``; ``exit``
leads to the next sibling's ``enter`` or, from the last one, to the parent's
``exit``.  Nodes are numbered by (parent, depth, name), so siblings stand side
by side, children's numbers are a range, and a path of one conversation is
mostly a stretch.  The list of arcs is ranked (``list_rank``): stretches of
``BLOCK`` numbers are cut to their chains, the chains are spliced by coin
tosses until few are left, and the places are handed back.  Prefix sums along
the places, at a node's two arcs, give the leaves and savings of its subtree.

No task holds the children of a node, the members of a node or a conversation:
siblings and ends are numbered by ranges, scans go by blocks, counts combine
before the shuffle.  The digest of the ids that end at a node is a stream of
strings of up to ``BLOCK`` ids, in one task for each node because SHA-256 is
sequential, with one string in memory.

Defined cases: null role and text are empty; turns with equal numbers stand in
the order of their digests, a null number first, and all of them count; rows
with a null ``conv_id`` are one conversation with nothing to borrow (h = 0),
larger than all others, named null and left out of ``ends_sha256`` (the id
2^63 - 1 stands for it and is taken for it); ``c % 100`` has the sign of c, as
in SQL; texts of any length are hashed whole and then left behind; other
columns are never read; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.common import scratch_table, sql_crc32
from squall.llm.ordering import numbered, running

HUNDRED, OPENING = 100, 6
BLOCK = 4096
FEW = 4096  # chains that one task may put in order
NO_ID = (1 << 63) - 1
_EMPTY = hashlib.sha256(b"").hexdigest()


def _lane(digest: Column, at: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def turns_in_order(convs: DataFrame, *, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, a, b, n_chars): a, b are the turn's digest."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = convs.select(F.coalesce(F.col(conv_id).cast("long"), F.lit(NO_ID)).alias("conv"), F.col(turn).alias("turn"),
                        F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256).alias("d"),
                        F.length(t).cast("long").alias("n_chars"))
    rows = rows.select("conv", "turn", _lane(F.col("d"), 1).alias("a"), _lane(F.col("d"), 17).alias("b"), "n_chars")
    return numbered(scratch_table(rows, "trie-turns"), ["conv"], ["turn", "a", "b"], "trie-order", place="pos").drop("turn")


def rebuilt(turns: DataFrame, hundred: int = HUNDRED, opening: int = OPENING) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, a, b, n_chars) of the rebuilt conversations, and (conv,
    total) with their lengths, 0 included."""
    turns = scratch_table(turns, "trie-places")
    own_h = F.when(F.col("conv") == NO_ID, F.lit(0)).otherwise(F.crc32(F.col("conv").cast("string").cast("binary")) % opening)
    convs = (turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumn("h", own_h.cast("long"))
             .withColumn("base", F.col("conv") - F.col("conv") % hundred))
    convs = scratch_table(convs, "trie-sizes")
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("kept", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))))
    convs = scratch_table(convs.select("conv", "base", "h", "kept", (F.col("kept") + F.greatest(
        F.col("n") - F.col("h"), F.lit(0))).alias("total")), "trie-shapes")
    rest = turns.join(convs.select("conv", "h", "kept"), "conv").filter("pos >= h").select(
        "conv", (F.col("kept") + F.col("pos") - F.col("h")).alias("pos"), "a", "b", "n_chars")
    first = turns.filter(F.col("pos") < opening - 1).withColumnRenamed("conv", "base")
    taken = convs.select("conv", "base", "kept").join(first, "base").filter("pos < kept").select("conv", "pos", "a", "b", "n_chars")
    return rest.unionByName(taken), convs.select("conv", "total")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, p1, p2, q1, q2, n_chars): a prefix is (depth, p1, p2) and
    goes on from (depth - 1, q1, q2)."""
    x = [F.xxhash64(F.lit(lane), "pos", "a", "b").alias(f"x{lane}") for lane in (1, 2)]
    turns = scratch_table(turns.select("conv", "pos", "n_chars", *x), "trie-rebuilt")
    both = running(turns, ["conv"], "pos", {"p1": "x1", "p2": "x2"}, F.bit_xor, lambda u, v: u.bitwiseXOR(v))
    return both.select("conv", (F.col("pos") + 1).alias("depth"), "p1", "p2",
                       *[F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"q{i}") for i in (1, 2)], "n_chars")


def _sha_of_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, p1, p2, chunk, ids), sorted, to one digest a prefix."""
    now, sha = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in now), pa.array([sha.hexdigest()])],
                                          ["depth", "p1", "p2", "ends_sha256"])
    for b in batches:
        for depth, p1, p2, ids in zip(*(b.column(c).to_pylist() for c in ("depth", "p1", "p2", "ids")), strict=True):
            if (depth, p1, p2) != now:
                if now:
                    yield row()
                now, sha = (depth, p1, p2), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
    if now:
        yield row()


def end_digests(ends: DataFrame, block: int = BLOCK) -> DataFrame:
    """(depth, p1, p2, ends_sha256) from (conv, depth, p1, p2)."""
    key = ["depth", "p1", "p2"]
    ends = numbered(scratch_table(ends.filter(F.col("conv") != NO_ID), "trie-ends"), key, ["conv"], "trie-end-order")
    chunks = (ends.groupBy(*key, F.expr(f"idx div {block}").alias("chunk"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids")))
    return (chunks.repartition(*key).sortWithinPartitions(*key, "chunk")
            .mapInArrow(_sha_of_stream, "depth long, p1 long, p2 long, ends_sha256 string"))


def _chains(table: pa.Table) -> pa.Table:
    """The arcs (id, nxt) of one block with their chain's first arc and the
    way from it; first arcs also say where the chain leads and how long it is."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids)
    ids, nxt = ids[order], table.column("nxt").fill_null(-1).to_numpy()[order]
    at = np.minimum(np.searchsorted(ids, nxt), len(ids) - 1)
    inside = ids[at] == nxt
    before, way = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    before[at[inside]] = np.flatnonzero(inside)
    way[at[inside]] = 1
    while way[before].any():  # double the way back until all stand on a first arc
        way, before = way + way[before], before[before]
    first = before == np.arange(len(ids))
    leads = np.full(len(ids), -1)
    leads[before[~inside]] = nxt[~inside]
    length = np.bincount(before, minlength=len(ids))
    return pa.table({"id": ids, "head": ids[before], "way": way,
                     "nxt": pa.array(leads, mask=~first | (leads < 0)), "len": pa.array(length, mask=~first)})


def _line_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The few chains (id, nxt, len) of the whole list to (id, at)."""
    rows = {i: (n, k) for b in batches for i, n, k in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    now, at, out = next(iter(set(rows) - {n for n, _ in rows.values()}), None), 0, []
    while now is not None:
        out.append((now, at))
        now, at = rows[now][0], at + rows[now][1]
    yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(2)], ["id", "at"])


def list_rank(arcs: DataFrame, *, block: int = BLOCK, few: int = FEW) -> DataFrame:
    """(id, at): the place from 0 of every arc (id, nxt) of one list, whose
    last arc has no ``nxt``."""
    chains = scratch_table(arcs.withColumn("__block", F.expr(f"id div {block}")).groupBy("__block").applyInArrow(
        _chains, "id long, head long, way long, nxt long, len long"), "trie-chains")
    left = chains.filter("id = head").select("id", "nxt", "len")
    spliced, n = [], left.count()
    while n > few:
        def tails(c: str) -> Column:
            return F.xxhash64(F.lit(len(spliced)), c).bitwiseAND(F.lit(1)) == 1
        # a chain with heads takes over the one that it leads to if that has tails
        takes = F.col("nxt").isNotNull() & ~tails("id") & tails("nxt")
        pairs = left.filter(takes).select(F.col("nxt").alias("id"), F.col("id").alias("by"), F.col("len").alias("by_len"))
        met = left.filter(~takes).join(pairs, "id", "left")
        met = scratch_table(met.select("id", "nxt", "len", "by", "by_len"), f"trie-splice-{len(spliced)}")
        spliced.append(met.filter("by IS NOT NULL").select("id", "by", "by_len"))
        left = met.filter("by IS NULL").select("id", "nxt", "len").unionByName(
            met.filter("by IS NOT NULL").select(F.col("by").alias("id"), "nxt", (F.col("len") + F.col("by_len")).alias("len")))
        n = left.count()
    ranks = left.repartition(1).mapInArrow(_line_up, "id long, at long")
    for no, taken in reversed(list(enumerate(spliced))):
        by = ranks.withColumnRenamed("id", "by")
        ranks = scratch_table(ranks.unionByName(
            taken.join(by, "by").select("id", (F.col("at") + F.col("by_len")).alias("at"))), f"trie-ranks-{no}")
    return chains.select("id", "head", "way").join(ranks.withColumnRenamed("id", "head"), "head").select(
        "id", (F.col("at") + F.col("way")).alias("at"))


def euler_tour(tree: DataFrame) -> DataFrame:
    """Arcs (id, nxt) of nodes (nid, n_children, first, last): 2 nid enters,
    2 nid + 1 leaves a node."""
    enters = tree.select((F.col("nid") * 2).alias("id"), F.when(F.col("n_children") > 0, F.col("first") * 2).otherwise(
        F.col("nid") * 2 + 1).alias("nxt"))
    lasts = tree.filter("n_children > 0").select(F.col("last").alias("nid"), F.col("nid").alias("parent"))
    exits = tree.select("nid").join(lasts, "nid", "left").select((F.col("nid") * 2 + 1).alias("id"), F.when(
        F.col("parent").isNotNull(), F.col("parent") * 2 + 1).when(F.col("nid") > 0, F.col("nid") * 2 + 2).alias("nxt"))
    return enters.unionByName(exits)


def subtree_sums(tree: DataFrame, weights: list[str], **options) -> DataFrame:
    """(nid, *weights): the sums over each node's subtree, its own included."""
    ranks = list_rank(euler_tour(tree), **options).withColumn("nid", F.expr("id div 2")).withColumn("enters", F.col("id") % 2 == 0)
    w = [F.when(F.col("enters"), F.col(c)).otherwise(F.lit(0)).cast("long").alias(c) for c in weights]
    tour = scratch_table(ranks.join(tree.select("nid", *weights), "nid").select("nid", "at", "enters", *w), "trie-tour")
    sums = running(tour, [], "at", {f"__to_{c}": c for c in weights}, F.sum, lambda u, v: u + v)
    return sums.groupBy("nid").agg(*[F.sum(F.when(F.col("enters"), F.col(c) - F.col(f"__to_{c}")).otherwise(
        F.col(f"__to_{c}"))).alias(c) for c in weights])


def prefix_trie(convs: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                hundred: int = HUNDRED, opening: int = OPENING, block: int = BLOCK, few: int = FEW) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``."""
    turns = turns_in_order(convs, conv_id=conv_id, turn=turn, role=role, text=text)
    turns, shapes = rebuilt(turns, hundred, opening)
    steps = scratch_table(prefixes(turns), "trie-prefixes")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "p1", "p2")]
    root = shapes.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        *zero, "conv", "n_convs", *[F.lit(None).cast("long").alias(c) for c in ("q1", "q2")], F.lit(0).cast("long").alias("n_chars"))
    nodes = steps.groupBy("depth", "p1", "p2").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"),
        *[F.min(c).alias(c) for c in ("q1", "q2", "n_chars")]).unionByName(root)
    nodes = scratch_table(nodes, "trie-nodes")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                      F.col("conv").alias("parent"))
    tree = scratch_table(nodes.join(up, ["depth", "q1", "q2"], "left").drop("q1", "q2"), "trie-parents")
    tree = scratch_table(numbered(tree, [], ["parent", "depth", "conv"], "trie-numbers", place="nid"), "trie-numbered")
    kids = tree.filter("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("nid").alias("first"), F.max("nid").alias("last"))
    tree = tree.join(kids, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    tree = tree.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn(
        "saved_tokens", (F.col("n_convs") - 1) * F.col("n_chars"))
    tree = scratch_table(tree, "trie-tree")
    sums = subtree_sums(tree, ["n_leaves", "saved_tokens"], block=block, few=few)
    ends = steps.join(shapes, "conv").filter("depth = total").select("conv", "depth", "p1", "p2").unionByName(
        shapes.filter("total = 0").select("conv", *zero))
    named = F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id")
    return (tree.drop("n_leaves", "saved_tokens").join(sums, "nid").join(end_digests(ends, block), ["depth", "p1", "p2"], "left")
            .select(named, "depth", F.when(F.col("parent") != NO_ID, F.col("parent")).alias("parent_conv_id"), "n_convs",
                    "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")))


# a node is the list of its turns; its subtree are the lists that go on from it
SQL = rf"""
WITH t AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, role, text) AS turns FROM conversations GROUP BY conv_id),
h AS (SELECT *, conv_id - conv_id % {HUNDRED} AS base, {sql_crc32("conv_id::VARCHAR")} % {OPENING} AS h FROM t),
b AS (SELECT h.conv_id, list_concat(coalesce(o.turns, [])[:h], h.turns[h + 1:]) AS turns
  FROM h LEFT JOIN t o ON o.conv_id = h.base),
p AS (SELECT conv_id, d, turns[:d] AS k, turns[:d - 1] AS up, len(turns) = d AS ends, turns[d].x AS x
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM b)),
n AS (SELECT d, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(length(x)), 0) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY d, k),
c AS (SELECT n.*, q.conv_id AS parent_conv_id, (SELECT count(*) FROM n m WHERE m.d = n.d + 1 AND m.up = n.k) AS n_children
  FROM n LEFT JOIN n q ON q.d = n.d - 1 AND q.k = n.up)
SELECT a.conv_id, a.d AS depth, a.parent_conv_id, a.n_convs, a.n_children, count(*) FILTER (z.n_children = 0) AS n_leaves,
  sum(CASE WHEN z.d > 0 THEN (z.n_convs - 1) * z.chars ELSE 0 END)::BIGINT AS saved_tokens, a.ends_sha256
FROM c a JOIN c z ON z.k[:a.d] = a.k AND z.d >= a.d
GROUP BY a.conv_id, a.d, a.parent_conv_id, a.n_convs, a.n_children, a.ends_sha256
"""
