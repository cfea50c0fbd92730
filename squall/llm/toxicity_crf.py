"""Toxicity: a linear-chain conditional random field over words.

Labels exist for documents only, so training words are labelled first: word
and prefix features far more common in toxic than in clean training documents
mark their words in toxic documents as toxic.  A two-state chain is trained on
these words; its emissions are sums of hashed word, prefix and
suffix features, so unseen words with known parts are covered.  To score a
document, forward-backward marginals of all its words add up to its evidence
of at least one toxic word, which a logistic link turns into the score; runs
of words with a marginal of one half or more are the offending spans.

The model is fitted on a bounded sample of labelled rows (``MAX_CLEAN`` and
``MAX_TOXIC`` documents of at most ``MAX_BYTES`` bytes, the smallest hashes of
the id); its size is fixed (2**18 weights), so it travels with the task.
Scoring runs over all documents and whole texts in one pass without a shuffle,
about a megabyte of text at a time.

Defined cases: a null text is empty; an empty text has the score of no
evidence; rows with the same ``doc_id`` are scored each; a null id is never
held out and never trained on; several labels of one id count as the highest;
null labels are left out; without a toxic and a clean training document every
score is 0; an empty table gives an empty result; input columns named like an
output column are replaced.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.common import bounded_batches, byte_slices

MAX_CLEAN, MAX_TOXIC, MAX_BYTES = 1800, 1200, 12_000
SPACE = 1 << 18
EPOCHS, RATE, DECAY = 30, 0.3, 1e-6
FOLDS = 5
_KEPT = 400_000
_OUT = ["score", "predicted", "n_spans", "spans"]

_fold = bytearray(b" " * 128 + bytes(range(128, 256)))
for _c in range(26):
    _fold[65 + _c] = _fold[97 + _c] = 97 + _c
#: ASCII letters in lower case, other bytes above 127 as they are, the rest blank; one byte stays one byte
_FOLD = bytes(_fold)
_TOKEN = re.compile(rb"[^ ]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _lexical(word: bytes) -> list[bytes]:
    """Features that may mark a training word: itself and its beginnings."""
    return [b"=" + word] + [b"^" + word[:k] for k in range(4, min(7, len(word)) + 1)]


def word_features(word: bytes) -> list[int]:
    w = b"^" + word + b"$"
    f = [b"=" + word]
    f += [w[:k] for k in range(3, min(8, len(w)) + 1)]
    f += [b"~" + w[-k:] for k in range(3, min(6, len(w)) + 1)]
    return [zlib.crc32(x) & (SPACE - 1) for x in f]


@dataclass
class Model:
    weights: np.ndarray  # emission of the toxic state by feature
    bias: float
    trans: np.ndarray  # log potentials, from x to
    start: float
    link: tuple[float, float, float]  # evidence, share, constant


def _scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, step: int = 64) -> np.ndarray:
    """v[t] = (a v + b) / (c v + d) of v[t-1], for all t: products of 2 x 2
    matrices over stretches of ``step`` places side by side, then along them."""
    n = len(a)
    cols = -(-n // step)
    pad = cols * step - n

    def lay(x: np.ndarray, fill: float) -> np.ndarray:
        return np.concatenate([x, np.full(pad, fill)]).reshape(cols, step).T.copy()

    a, b, c, d = lay(a, 1.0), lay(b, 0.0), lay(c, 0.0), lay(d, 1.0)
    pa_, pb, pc, pd = a[0].copy(), b[0].copy(), c[0].copy(), d[0].copy()
    for i in range(1, step):
        na, nb = a[i] * pa_ + b[i] * pc, a[i] * pb + b[i] * pd
        nc, nd = c[i] * pa_ + d[i] * pc, c[i] * pb + d[i] * pd
        s = 1.0 / np.maximum(np.maximum(na, nb), np.maximum(nc, nd))
        pa_, pb, pc, pd = na * s, nb * s, nc * s, nd * s
    v, into = 1.0, np.empty(cols)
    for j, (x, y, z, w) in enumerate(zip(pa_.tolist(), pb.tolist(), pc.tolist(), pd.tolist(), strict=True)):
        into[j] = v
        v = (x * v + y) / (z * v + w)
    out = np.empty((step, cols))
    v = into
    for i in range(step):
        v = (a[i] * v + b[i]) / (c[i] * v + d[i])
        out[i] = v
    return out.T.reshape(-1)[:n]


def chain(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Ratios toxic : other of the forward and the backward messages of a row
    of chains; ``first`` marks where each begins."""
    x = np.exp(np.clip(emit, -30, 30))
    (oo, ot), (to, tt) = np.exp(trans)
    go = ~first
    fwd = _scan(np.where(go, x * tt, 0.0), np.where(go, x * ot, x * math.exp(start)),
                np.where(go, to, 0.0), np.where(go, oo, 1.0))
    # backward, from the last place; what follows a chain's last place is none
    follows = np.append(go[1:], False)
    nxt = np.append(x[1:], 1.0)
    rev = lambda y: y[::-1].copy()
    bwd = rev(_scan(rev(np.where(follows, tt * nxt, 0.0)), rev(np.where(follows, to, 1.0)),
                    rev(np.where(follows, ot * nxt, 0.0)), rev(np.where(follows, oo, 1.0))))
    return fwd, bwd


def marginals(emit: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    f, b = chain(emit, first, model.trans, model.start)
    r = f * b
    return r / (1 + r)


def _evidence(p: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: -log of no toxic word (by marginals), toxic share."""
    ends = np.cumsum(lens)
    total = np.concatenate([[0.0], np.cumsum(-np.log1p(-np.minimum(p, 1 - 1e-9)))])
    share = np.concatenate([[0.0], np.cumsum(p)])
    return total[ends] - total[ends - lens], (share[ends] - share[ends - lens]) / np.maximum(lens, 1)


def _linked(e: np.ndarray, share: np.ndarray, link: tuple[float, float, float]) -> np.ndarray:
    z = link[0] * np.log1p(np.maximum(e, 0)) + link[1] * np.sqrt(np.maximum(share, 0)) + link[2]
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, name: str, x, g):
        m = self.m[name] = 0.9 * self.m.get(name, 0) + 0.1 * g
        v = self.v[name] = 0.99 * self.v.get(name, 0) + 0.01 * g * g
        return x - self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.99 ** self.t)) + 1e-9)


def toxic_marks(docs: list[list[bytes]], y: np.ndarray) -> set[bytes]:
    """Features far more common in toxic than in clean documents that explain
    toxic documents which no more common mark explains: what copies of one
    toxic document share by chance is explained by its marks already."""
    n1, n0 = y.sum(), (~y).sum()
    clean: Counter = Counter()
    holders = defaultdict(list)
    for i in np.flatnonzero(y):
        for f in {f for w in set(docs[i]) for f in _lexical(w)}:
            holders[f].append(i)
    for i in np.flatnonzero(~y):
        clean.update({f for w in set(docs[i]) for f in _lexical(w) if f in holders})
    rare = [f for f, ds in holders.items() if len(ds) >= 3 and len(ds) / n1 > 20 * (clean[f] + 0.5) / n0]
    explained, marks = np.zeros(len(docs), bool), set()
    for f in sorted(rare, key=lambda f: (-len(holders[f]), len(f), f)):
        if len(holders[f]) >= 0.05 * n1 or (~explained[holders[f]]).sum() >= 3:
            marks.add(f)
            explained[holders[f]] = True
    return marks


def train(texts: list[bytes], toxic: list[int], prior: float | None = None) -> Model | None:
    """``prior``: share of toxic rows among all labelled training rows."""
    copies = dict(zip(texts, toxic, strict=True))  # one of each text
    docs = [t.translate(_FOLD).split() for t in copies]
    y = np.array(list(copies.values()), bool)
    if not y.any() or y.all():
        return None
    marks = toxic_marks(docs, y)
    types: dict[bytes, int] = {}
    ids = [np.fromiter((types.setdefault(w, len(types)) for w in ws), np.int64, len(ws)) for ws in docs]
    marked = np.array([any(f in marks for f in _lexical(w)) for w in types] or [False])
    lens = np.array([len(i) for i in ids])
    word = np.concatenate(ids)
    if not len(word):
        return None
    first = np.zeros(len(word), bool)
    first[(np.cumsum(lens) - lens)[lens > 0]] = True
    del docs, copies, ids
    gold = marked[word] & np.repeat(y, lens)
    feats = [word_features(w) for w in types]
    f_len = np.array([len(f) for f in feats])
    f_id, f_type = np.concatenate(feats), np.repeat(np.arange(len(feats)), f_len)
    weights, bias, trans, start = np.zeros(SPACE), -2.0, np.zeros((2, 2)), 0.0
    adam, go = _Adam(RATE), ~first
    prev, here = gold[:-1][go[1:]], gold[1:][go[1:]]
    real = np.array([[(~prev & ~here).sum(), (~prev & here).sum()], [(prev & ~here).sum(), (prev & here).sum()]], float)
    n = gold.sum() + 1.0
    for _ in range(EPOCHS):
        adam.t += 1
        emit = (np.bincount(f_type, weights[f_id], len(feats)) + bias)[word]
        f, b = chain(emit, first, trans, start)
        p = f * b / (1 + f * b)
        g_emit = p - gold
        by_type = np.bincount(word, g_emit, len(feats))
        x = np.exp(np.clip(emit, -30, 30))[1:][go[1:]] * b[1:][go[1:]]
        r = f[:-1][go[1:]]
        pot = np.exp(trans)
        w = np.array([np.full(len(r), pot[0, 0]), pot[0, 1] * x, r * pot[1, 0], r * pot[1, 1] * x])
        expect = (w / w.sum(axis=0)).sum(axis=1).reshape(2, 2)
        weights = adam.step("w", weights, np.bincount(f_id, by_type[f_type], SPACE) / n + DECAY * weights)
        bias = float(adam.step("b", bias, g_emit.sum() / n))
        trans = adam.step("t", trans, (expect - real) / n + DECAY * trans)
        start = float(adam.step("s", start, g_emit[first].sum() / n))
    model = Model(weights.astype(np.float32), bias, trans, start, (1.0, 0.0, 0.0))
    e, share = _evidence(marginals((np.bincount(f_type, weights[f_id], len(feats)) + bias)[word], first, model), lens)
    z = np.stack([np.log1p(e), np.sqrt(share), np.ones(len(e))])
    # rows count as often as their class among all labelled rows
    prior = y.mean() if prior is None else prior
    row = np.where(y, prior / y.mean(), (1 - prior) / (~y).mean())
    link, adam = np.zeros(3), _Adam(0.1)
    for _ in range(400):
        adam.t += 1
        q = 1 / (1 + np.exp(-np.clip(link @ z, -35, 35)))
        link = adam.step("l", link, (z * (row * (q - y))).mean(axis=1) + 1e-4 * link * [1, 1, 0])
    model.link = tuple(map(float, link))
    return model


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", max_clean: int = MAX_CLEAN, max_toxic: int = MAX_TOXIC,
        max_bytes: int = MAX_BYTES) -> Model | None:
    """Fit on labelled rows outside the held-out fold."""
    rows = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
            .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
            .groupBy("id").agg((F.max("y") > 0).cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    short = docs.select(F.col(doc_id).alias("id"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).alias("n")).filter(
        F.col("n") <= max_bytes).select("id")
    order = [F.xxhash64("id"), F.col("id")]
    pool = rows.join(short, "id", "left_semi")
    chosen = (pool.filter("y = 1").orderBy(*order).limit(max_toxic)
              .unionByName(pool.filter("y = 0").orderBy(*order).limit(max_clean)))
    # at most max_clean + max_toxic ids, so they may be broadcast
    sample = (docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("t"))
              .filter(F.octet_length("t") <= max_bytes).join(F.broadcast(chosen), "id")
              .groupBy("id", "y").agg(F.min("t").alias("t")))
    # the bounded sample is trained on in one task, not in the driver
    prior = counts[1] / (counts[0] + counts[1])
    got = sample.select("id", "t", "y").repartition(1).mapInArrow(_trainer(prior), "model binary").collect()
    if not got:
        return None
    parts = pickle.loads(bytes(got[0]["model"]))
    return Model(*parts) if parts else None


def _trainer(prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        if rows:
            m = train([r[1] for r in rows], [r[2] for r in rows], prior)
            parts = m and (m.weights, m.bias, m.trans, m.start, m.link)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(parts)], pa.binary())], ["model"])
    return run


def _scorer(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}

        def emission(word: bytes) -> float:
            if len(known) >= _KEPT:
                known.clear()
            e = known[word] = float(model.weights[word_features(word)].sum()) + model.bias
            return e

        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])
        for b in (part for whole in batches for part in byte_slices(whole)):
            folded = [(t.as_py() or b"").translate(_FOLD) for t in b.column(b.num_columns - 1)]
            docs = [t.split() for t in folded] if model else [[]] * len(folded)
            lens = np.array([len(d) for d in docs], np.int64)
            emit = np.fromiter((known[w] if w in known else emission(w) for d in docs for w in d), np.float64, lens.sum())
            first = np.zeros(len(emit), bool)
            first[(np.cumsum(lens) - lens)[lens > 0]] = True
            p = marginals(emit, first, model) if len(emit) else emit
            score = _linked(*_evidence(p, lens), model.link) if model else np.zeros(len(docs))
            spans, ends = [], np.cumsum(lens)
            for i, (end, n) in enumerate(zip(ends, lens, strict=True)):
                own, out = p[end - n:end], []
                hot = np.flatnonzero(own >= 0.5)
                if len(hot):
                    at = [m.span() for m in _TOKEN.finditer(folded[i])]
                    for run_ in np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1):
                        out.append({"start": at[run_[0]][0], "end": at[run_[-1]][1], "p": float(own[run_].max())})
                spans.append(out)
            cols = [*b.columns[:-1], pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32)),
                    pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names[:-1], *_OUT])
    return run


def score_documents(docs: DataFrame, model: Model | None, *, text: str = "text",
                    columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all by default) plus ``score``, ``predicted``
    (score of one half or more), ``n_spans`` and ``spans`` (byte offsets in
    the text's UTF-8)."""
    bounded_batches(docs.sparkSession)
    rest = (docs if columns is None else docs.select(*columns)).drop(*_OUT)
    rows = docs.select(*rest.columns, F.col(text).cast("string").cast("binary").alias("__utf8"))
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rows.mapInArrow(_scorer(model), f"{names}, score double, predicted int, n_spans long, "
                           "spans array<struct<start: bigint, end: bigint, p: double>>")
