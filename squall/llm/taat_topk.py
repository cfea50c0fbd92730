"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights.  A candidate block keeps one
postings list per dimension (places with a non-zero weight, and the weights);
every query scatters its weighted postings, dimension by dimension, into a
dense score array over the block; the best k of the block are found by
partition selection, and the blocks' lists are merged by rank.

Nothing is pruned, so the result is exact.  Blocks are packed by the tasks
that read the rows (``block_rows`` candidates, ``query_rows`` queries at
most), so no task holds more than one block of either side.  Query blocks are
dealt to ``lanes`` groups of candidate blocks by an equi-join on the lane;
what moves is queries x lanes plus the candidates once.

Defined cases: a vector that is null or holds a null or a non-finite
component takes no part, as query or as candidate; an empty vector scores 0
against everything; vectors of different lengths are compared over the
dimensions that both have; rows that repeat a ``vec_id`` are one candidate
whose score is the best of its rows (and never an answer to their own id), and
a repeated query id has one list, ranked over the best scores of its rows;
rows with a null id take no part; ties go to the smaller id; weights must be
small enough for a 64-bit inner product; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
QUERY_ROWS = 1024
LANES = 32
_BLOCK = "block binary"


def quantise(vectors: DataFrame, *, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(id, w): integer weights floor(scale * x) of the vectors that take part."""
    x = F.col(embedding)
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return (vectors.select(F.col(vec_id).cast("long").alias("id"), x.cast("array<double>").alias("x"))
            .filter(F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
            .select("id", F.transform("x", lambda v: F.floor(v * scale)).alias("w")))


def _pack(rows_per_block: int):
    """Rows (id, w) to blocks: one Arrow record batch each, as bytes."""
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, rows_per_block - n)
                held, n, b = [*held, part], n + part.num_rows, b.slice(part.num_rows)
                if n == rows_per_block:
                    yield one(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, n = [], 0
        if n:
            yield one(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
    return run


def _open(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, and the non-zero weights as (row, dimension, weight), by dimension."""
    t = pa.ipc.open_stream(block).read_all().combine_chunks()
    ids = t["id"].to_numpy()
    lists = t["w"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    weights = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(ids)), lengths)
    dims = np.arange(len(weights)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = np.flatnonzero(weights)
    order = some[np.argsort(dims[some], kind="stable")]
    return ids, rows[order], dims[order], weights[order]


def accumulate(query: bytes, cand: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores (queries x candidates) of two blocks, term at a time."""
    q_ids, q_rows, q_dims, q_w = _open(query)
    c_ids, c_rows, c_dims, c_w = _open(cand)
    score = np.zeros((len(q_ids), len(c_ids)), np.int64)
    terms = np.intersect1d(q_dims, c_dims)
    for t, qa, qz, ca, cz in zip(terms, np.searchsorted(q_dims, terms), np.searchsorted(q_dims, terms, "right"),
                                 np.searchsorted(c_dims, terms), np.searchsorted(c_dims, terms, "right"), strict=True):
        at, w = c_rows[ca:cz], c_w[ca:cz]
        dense = len(at) == len(c_ids)
        for r, v in zip(q_rows[qa:qz], q_w[qa:qz], strict=True):
            if dense:
                score[r] += v * w
            else:
                score[r, at] += v * w
    return q_ids, c_ids, score


def _best(k: int):
    def select(q_ids: np.ndarray, c_ids: np.ndarray, score: np.ndarray):
        ids, first = np.unique(c_ids, return_index=True)
        if len(ids) < len(c_ids):  # rows of one id: the best of them
            order = np.argsort(c_ids, kind="stable")
            score = np.maximum.reduceat(score[:, order], np.searchsorted(c_ids[order], ids), axis=1)
        else:
            score = score[:, first]
        out = []
        for q, s in zip(q_ids, score, strict=True):
            own = np.searchsorted(ids, q)
            keep = np.ones(len(ids), bool)
            if own < len(ids) and ids[own] == q:
                keep[own] = False
            s, c = s[keep], ids[keep]
            if len(s) > k:
                kth = np.partition(s, len(s) - k)[len(s) - k]
                over, ties = np.flatnonzero(s > kth), np.flatnonzero(s == kth)  # ids ascend
                at = np.concatenate([over, ties[: k - len(over)]])
                s, c = s[at], c[at]
            out.append((np.full(len(s), q), c, s))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q, c in zip(b["q"], b["c"], strict=True):
                hits = select(*accumulate(q.as_py(), c.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([h[i] for h in hits]), pa.int64()) for i in range(3)],
                    ["query_id", "vec_id", "score"])
    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int, *, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS, lanes: int = LANES) -> DataFrame:
    """The k best candidates of every query; both sides are (id, w) rows."""
    c = candidates.mapInArrow(_pack(block_rows), _BLOCK).withColumn(
        "lane", F.pmod(F.xxhash64("block"), F.lit(lanes)))
    # few full blocks instead of a small one from each task
    n = max(1, -(-queries.count() // query_rows))
    q = (queries.repartition(n).mapInArrow(_pack(query_rows), _BLOCK)
         .withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long")))))
    pairs = q.select("lane", F.col("block").alias("q")).join(c.select("lane", F.col("block").alias("c")), "lane")
    hits = pairs.select("q", "c").mapInArrow(_best(k), "query_id long, vec_id long, score long")
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def embedding_top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, vec_id: str = "vec_id",
                    embedding: str = "embedding", scale: int = 256, **sizes) -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``."""
    rows = quantise(vectors, vec_id=vec_id, embedding=embedding, scale=scale)
    return top_k(rows.filter(F.col("id") % every == 0), rows, k, **sizes)


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
t AS (SELECT vec_id, unnest(w) AS w, unnest(range(len(w))) AS d FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.w * c.w)::BIGINT AS score
      FROM t q JOIN t c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
