"""Merkle dataset manifest.

Every row is a leaf, the SHA-256 of its framed fields.  Per group (source) the
leaves ascend by key; level by level every ``FANOUT`` consecutive nodes become
the digest of their digests, down to one subroot, and the subroots, ordered by
group, become the root in the same way.  A leaf's proof is the digests beside
its path: with them anyone can fold a leaf up to the root and compare.

Per level, lag and lead columns with the offsets 1 .. ``FANOUT`` - 1, masked
by the node's slot and its run's length, are the siblings of a node; the first
child of a run hashes them to the parent.  A window holds one run, so a group
with a third of all rows is spread like any other; places come from ranges
(``ordering.numbered``).  Going down, a node's path is its siblings before its
parent's path, an equi-join on the run by which the window was dealt already.
Only built-in functions are used.  A job has one round per level, that is
log16 of the largest group.

Defined cases: null fields are framed as ``-``, an empty text as ``0:``; a
null key comes first and is tampered with by no check; rows with equal keys
are ordered by their leaves (equal rows are interchangeable); a null group is
a group of its own, the first; a group with one row has its leaf as subroot
and a lone subroot is the root; texts of any length are hashed whole; an empty
table gives an empty result; columns other than the fields are never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.common import scratch_table, sql_crc32
from squall.llm.ordering import numbered

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_OF = 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PATH = "array<struct<left:string,right:string>>"


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """nodes (g, idx, digest ...) plus ``run``, ``slot``, ``m`` (the run's
    length), ``done`` (the group's only node) and the digests ``left`` and
    ``right`` of it in its run."""
    df = nodes.withColumn("run", F.expr(f"idx div {fanout}")).withColumn("slot", F.col("idx") % fanout)
    run = Window.partitionBy("g", "run")
    df = df.withColumn("m", F.count(F.lit(1)).over(run))
    along, none = run.orderBy("idx"), F.lit("")
    left = [F.when(F.col("slot") >= k, F.lag("digest", k).over(along)).otherwise(none) for k in range(fanout - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < F.col("m"), F.lead("digest", k).over(along)).otherwise(none) for k in range(1, fanout)]
    return (df.withColumn("left", F.concat(*left)).withColumn("right", F.concat(*right))
            .withColumn("done", (F.col("run") == 0) & (F.col("m") == 1)))


def grow(leaves: DataFrame, name: str, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of every level from the leaves on, and (g, digest, level) of
    each group's last node."""
    levels, tops, nodes = [], None, leaves
    while True:
        levels.append(nodes)
        heads = with_siblings(nodes, fanout).filter("slot = 0")
        up = heads.select("g", F.col("run").alias("idx"), "done", F.when(F.col("done"), F.col("digest")).otherwise(
            F.sha2(F.concat("digest", "right"), 256)).alias("digest"))
        up = scratch_table(up, f"{name}-{len(levels)}")
        top = up.filter("done").select("g", "digest", F.lit(len(levels) - 1).alias("level"))
        tops = top if tops is None else tops.unionByName(top)
        nodes = up.filter("NOT done").select("g", "idx", "digest")
        if nodes.isEmpty():
            return levels, tops


def descend(levels: list[DataFrame], ends: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The leaves with ``path`` (left and right siblings, level by level) and
    the further columns of ends (g, level, path ...), which says how the path
    of each group's last node goes on."""
    more = [c for c in ends.columns if c not in ("g", "level")]
    above = None
    for level in range(len(levels) - 1, -1, -1):
        # a group that ends here has no node above, so its run is free for its end
        here = ends.filter(F.col("level") == level).select("g", F.lit(0).cast("long").alias("idx"), *more)
        above = (here if above is None else above.select("g", "idx", *more).unionByName(here)).withColumnsRenamed(
            {"g": "__g", "idx": "__idx"})
        own = with_siblings(levels[level], fanout)
        path = F.when(F.col("done"), F.col("path")).otherwise(F.concat(F.array(F.struct("left", "right")), "path"))
        above = (own.join(above, (own["g"] == above["__g"]) & (own["run"] == above["__idx"]))
                 .select(*levels[level].columns, *[path.alias("path") if c == "path" else c for c in more]))
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda d, p: F.sha2(F.concat(p["left"], d, p["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def merkle_manifest(docs: DataFrame, *, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS,
                    text: str = "text", tampered_of: int = TAMPERED_OF, fanout: int = FANOUT) -> DataFrame:
    """One row per input row: the key, ``leaf``, ``subroot``, ``root``,
    ``path``, ``proof_sha256``, ``folded_root`` and ``verified``.

    The check folds the leaf of what the row is now; where ``tampered_of``
    divides the CRC-32 of the key the text's ASCII capitals are made small
    first, so a tampered row fails if its text has any.
    """
    own = [F.col(f) for f in fields]
    small = [F.translate(F.col(f).cast("string"), _UPPER, _UPPER.lower()) if f == text else F.col(f) for f in fields]
    tampered = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % tampered_of == 0, F.lit(False))
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("n")).alias("g"),  # null first
        F.col(key).alias("id"), leaf_digest(own).alias("digest"), F.when(tampered, leaf_digest(small)).alias("seen"))
    leaves = numbered(scratch_table(leaves, "merkle-leaves"), ["g"], ["id", "digest"], "merkle-order")
    levels, tops = grow(leaves, "merkle-level", fanout)
    subroots = numbered(scratch_table(tops, "merkle-subroots"), [], ["g"], "merkle-sources").select(
        F.lit("").alias("g"), "idx", "digest", F.col("g").alias("of"), F.col("level").alias("ends_at"))
    upper, top = grow(subroots, "merkle-upper", fanout)
    ends = descend(upper, top.select("g", "level", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root")), fanout)
    ends = scratch_table(ends.select(F.col("of").alias("g"), F.col("ends_at").alias("level"), "path",
                                     F.col("digest").alias("subroot"), "root"), "merkle-ends")
    rows = descend(levels, ends, fanout).withColumn("folded_root", fold(F.coalesce("seen", "digest"), F.col("path")))
    return rows.select(F.col("id").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path",
                       proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(text: str) -> str:
    frame = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    return "sha256(" + " || ".join(frame.format(text if f == "text" else f) for f in FIELDS) + ")"


# level by level: the runs' digests, then every node's siblings; the upper tree's levels follow from 100 on
SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {_sql_leaf("text")}) - 1 AS idx,
    {_sql_leaf("text")} AS leaf,
    CASE WHEN {sql_crc32("doc_id::VARCHAR")} % {TAMPERED_OF} = 0
      THEN {_sql_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} ELSE {_sql_leaf("text")} END AS seen
  FROM documents),
t AS (
  SELECT 0 AS l, source AS g, idx, leaf AS x FROM d
  UNION ALL
  SELECT l + 1, g, idx // {FANOUT}, sha256(string_agg(x, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM t) WHERE n > 1 GROUP BY l, g, idx // {FANOUT}),
sub AS (SELECT g, l AS top, x AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS no
  FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY l DESC) AS r FROM t) WHERE r = 1),
u AS (
  SELECT 100 AS l, no AS idx, subroot AS x FROM sub
  UNION ALL
  SELECT l + 1, idx // {FANOUT}, sha256(string_agg(x, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY l, idx // {FANOUT}),
root AS (SELECT x AS root, l AS last FROM u ORDER BY l DESC LIMIT 1),
spot AS (SELECT doc_id, leaf, seen, l, source AS g, idx // ({FANOUT} ** l)::BIGINT AS i
       FROM d JOIN sub ON source IS NOT DISTINCT FROM g, unnest(range(top)) AS s(l)
  UNION ALL SELECT doc_id, leaf, seen, l, NULL, no // ({FANOUT} ** (l - 100))::BIGINT
       FROM d JOIN sub ON source IS NOT DISTINCT FROM g, root, unnest(range(100, last)) AS s(l)),
nodes AS (SELECT l, g, idx, x FROM t UNION ALL SELECT l, NULL, idx, x FROM u),
way AS (
  SELECT doc_id, leaf, seen, spot.l, coalesce(string_agg(x, '' ORDER BY idx) FILTER (idx < i), '') AS lhs,
    coalesce(string_agg(x, '' ORDER BY idx) FILTER (idx > i), '') AS rhs
  FROM spot JOIN nodes n ON n.l = spot.l AND n.g IS NOT DISTINCT FROM spot.g AND n.idx // {FANOUT} = i // {FANOUT}
  GROUP BY doc_id, leaf, seen, spot.l, i),
p AS (SELECT doc_id, leaf, seen, list(lhs ORDER BY l) AS ls, list(rhs ORDER BY l) AS rs FROM way GROUP BY ALL),
f AS (
  SELECT doc_id, leaf, 0 AS k, seen AS y, ls, rs FROM p
  UNION ALL SELECT doc_id, leaf, k + 1, sha256(ls[k + 1] || y || rs[k + 1]), ls, rs FROM f WHERE k < len(ls)),
e AS (SELECT doc_id, leaf, y, sha256(array_to_string(list_transform(range(1, len(ls) + 1), lambda j: ls[j] || rs[j]), '')) AS proof
  FROM f WHERE k = len(ls))
SELECT d.doc_id, d.leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, coalesce(y, seen) AS folded_root,
  coalesce(y, seen) = root AS verified
FROM d JOIN sub ON source IS NOT DISTINCT FROM g CROSS JOIN root
LEFT JOIN e ON e.doc_id IS NOT DISTINCT FROM d.doc_id AND e.leaf = d.leaf
"""
