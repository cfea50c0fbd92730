"""Quality classifier: Bradley-Terry pairwise ranking.

A document is described by measures of its text (lengths, shares of symbol,
capital, digit and other characters, repetition of words and lines).  Each
measure goes through a piecewise linear ramp between quantiles of the training
rows.  Preference pairs put every document of good quality over every one of
bad quality, and the weights minimise the mean logistic loss of the pairs'
feature differences, so a document's strength is learnt, not its class.  The
strength at the quantile that is the share of bad rows among the training
labels is the threshold: it becomes the score ``CUT``, with a logistic slope
fitted to the labels.

The model is fitted on all labelled rows outside the held-out fold, whole
texts.  Their measures are kept in the shared checkpoint folder; every step is
a sum over these rows, taken in tasks and added up as whole numbers in a tree,
so it is the same in any order, and the driver holds tables of a fixed size
only.  Quantiles are exact order statistics (of 32-bit floats), found digit by
digit.  The weights come from Newton steps on the loss over all pairs, which
meet through ``BINS`` stretches of strength for each class, a row counting
with the mean strength of its stretch.  All documents are scored on whole
texts, in one pass without a shuffle.

Defined cases: a null text is empty and is scored like any text; rows with the
same ``doc_id`` are scored each; a null id is never held out and never trained
on; several labels of one id count as the highest; null labels are left out;
without good and bad training rows every score is one half; an empty table
gives an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.common import bounded_batches, cut_lineage

RAMPS = 8
CUT = 0.3
FOLDS = 5
BINS, STEPS, DECAY = 256, 40, 1e-4
TASK_ROWS = 8192  # training rows of a task
UNIT = 2.0 ** 30  # sums are counted in fractions of this
_OUT = ["score", "predicted"]

# classes of bytes: blank, line break, small, capital, digit, plain and other punctuation, control, beyond ASCII
_CLASS = np.full(256, 7, np.uint8)
for _no, _set in enumerate((b" \t\x0b\f\r", b"\n", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:'\"()-",
                            b"!?#$%&*+/<=>@[\\]^_`{|}~")):
    _CLASS[list(_set)] = _no
_CLASS[128:] = 8
_N = 9


def measures(text: bytes) -> list[float]:
    """What is known of a text."""
    n = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=_N).astype(float)
    words = text.split()
    held = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    size, count = max(len(text), 1), max(len(words), 1)
    letters = max(n[2] + n[3] + n[8], 1)
    marked = sum(c for w, c in held.items() if w[-1] in b"!?#$%&*+/<=>@[\\]^_`{|}~")
    twice = sum(a == b for a, b in zip(words, words[1:]))
    return [math.log1p(len(words)), math.log1p(len(text)), math.log1p(len(lines)),
            n[3] / letters, n[8] / letters, n[4] / size, n[5] / size, n[6] / size, n[7] / size,
            (n[2] + n[3] + n[8]) / size, (n[0] + n[1]) / size,
            marked / count, sum(c for w, c in held.items() if len(w) == 1) / count,
            sum(len(w) * c for w, c in held.items()) / count, max(map(len, held), default=0),
            len(held) / count, max(held.values(), default=0) / count, twice / count,
            len(held) / math.sqrt(count), len(set(lines)) / max(len(lines), 1), count / max(len(lines), 1)]


@dataclass
class Model:
    edges: np.ndarray  # measure x edges of the ramps
    weights: np.ndarray  # of the ramps, measure by measure
    cut: float  # strength at the threshold
    slope: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def ramps(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Every measure's way through each of its stretches, 0 to 1."""
    low, high = edges[:, :-1], edges[:, 1:]
    at = (x[:, :, None] - low) / np.where(high > low, high - low, 1.0)
    return np.clip(at, 0, 1).reshape(len(x), -1)


def strengths(x: np.ndarray, model: Model) -> np.ndarray:
    return ramps(x, model.edges) @ model.weights


def scores(x: np.ndarray, model: Model) -> np.ndarray:
    z = model.slope * (strengths(x, model) - model.cut) + math.log(CUT / (1 - CUT))
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


Block = Callable[[np.ndarray, np.ndarray], np.ndarray]  # measures and classes of some rows -> their share of a sum
Total = Callable[[Block], np.ndarray]  # the sum over all rows


def _keys(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of 32-bit floats."""
    bits = (np.asarray(x, np.float32) + np.float32(0)).view(np.uint32).astype(np.int64)
    return np.where(bits >> 31 == 1, 0xFFFFFFFF - bits, bits + 0x80000000)


def _floats(keys: np.ndarray) -> np.ndarray:
    bits = np.where(keys >> 31 == 1, keys - 0x80000000, 0xFFFFFFFF - keys)
    return bits.astype(np.uint32).view(np.float32).astype(float)


def _at_weight(total: Total, values: Callable[[np.ndarray], np.ndarray], columns: np.ndarray, weights: np.ndarray,
               goals: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each target the smallest of its column's values up to which the
    rows weigh the goal or more (a row of class c weighs ``weights[target,
    c]``; the largest value if they never do), and what they weigh."""
    found, below = np.zeros(len(columns), np.int64), np.zeros(len(columns))
    for shift in range(32 - bits, -1, -bits):
        def count(x: np.ndarray, good: np.ndarray, shift=shift, found=found) -> np.ndarray:
            keys = _keys(values(x))
            out = []
            for c, top in zip(columns, found):
                here = keys[:, c] >> shift
                of = here >> bits == top
                out.append(np.bincount((good[of].astype(np.int64) << bits) + (here[of] & ((1 << bits) - 1)), minlength=2 << bits))
            return np.concatenate(out).astype(float)
        seen = (total(count).reshape(len(columns), 2, -1) * weights[:, :, None]).sum(axis=1)
        reached = below[:, None] + np.cumsum(seen, axis=1)
        there = (reached >= goals[:, None]) & (seen > 0)
        last = seen.shape[1] - 1 - np.argmax(seen[:, ::-1] > 0, axis=1)
        digit = np.where(there.any(axis=1), np.argmax(there, axis=1), last)
        at = np.arange(len(columns)), digit
        found, below, upto = found << bits | digit, reached[at] - seen[at], reached[at]
    return _floats(found), upto


def _quantiles(total: Total, n: np.ndarray, n_measures: int, at: np.ndarray) -> np.ndarray:
    """Class x measure x quantile of all rows."""
    kind, column, no = (v.ravel() for v in np.meshgrid([0, 1], np.arange(n_measures), np.arange(len(at)), indexing="ij"))
    goals = np.floor(at[no] * (n[kind] - 1)) + 0.5
    got, _ = _at_weight(total, lambda x: x, column, np.eye(2)[kind], goals, 8)
    return got.reshape(2, n_measures, len(at))


def _weights(total: Total, n: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Weights of least mean loss over all pairs of a good and a bad row."""
    size = edges.shape[0] * (edges.shape[1] - 1)

    def spread(x, good, w, low, high):
        f = ramps(x, edges)
        no = np.clip(((f @ w - low) * (BINS / (high - low))).astype(np.int64), 0, BINS - 1)
        return f, no + BINS * good

    def bins(w, low, high):
        def run(x, good):
            f, no = spread(x, good, w, low, high)
            out = np.zeros((2 * BINS, size + 1))
            order = np.argsort(no, kind="stable")
            held, first = np.unique(no[order], return_index=True)
            out[held, 0] = np.diff(np.append(first, len(no)))
            out[held, 1:] = np.add.reduceat(f[order], first, axis=0)
            return out.ravel()
        return total(run).reshape(2, BINS, size + 1)

    def squares(w, low, high, per_bin):
        def run(x, good):
            f, no = spread(x, good, w, low, high)
            return np.stack([(f[good == c].T * per_bin[no[good == c]]) @ f[good == c] for c in (False, True)]).ravel()
        return total(run).reshape(2, size, size)

    w, low, high = np.zeros(size), -1.0, 1.0
    best, step, mean, spreads = np.inf, 1.0, None, None
    old, way = w, np.zeros(size)
    for _ in range(STEPS):
        held = bins(w, low, high)
        count, sums = held[:, :, 0], held[:, :, 1:]
        at = (sums @ w) / np.maximum(count, 1)  # mean strength of a bin
        margin = np.clip(at[1][:, None] - at[0][None, :], -35, 35)  # good bin x bad bin
        share = (count[1] / n[1])[:, None] * (count[0] / n[0])[None, :]
        loss = float((share * np.log1p(np.exp(-margin))).sum() + DECAY / 2 * w @ w)
        if loss > best - 1e-7:  # no gain: half the step, at most as far as it matters
            if step < 0.01 or not np.isfinite(best):
                return old
            step /= 2
        else:
            miss = 1 / (1 + np.exp(margin))  # chance given to the worse one
            pull, turn = share * miss, share * miss * (1 - miss)
            each = sums / np.maximum(count, 1)[:, :, None]  # mean features of a bin
            grad = DECAY * w - pull.sum(axis=1) @ each[1] + pull.sum(axis=0) @ each[0]
            per_bin = np.concatenate([turn.sum(axis=0), turn.sum(axis=1)]) * (n[0] + n[1]) / np.maximum(count.ravel(), 1)
            both = squares(w, low, high, per_bin)
            cross = each[1].T @ turn @ each[0]
            curve = both.sum(axis=0) / (n[0] + n[1]) - cross - cross.T + DECAY * np.eye(size)
            if spreads is None:  # at weight zero every pair turns alike
                mean = sums.sum(axis=1) / n[:, None]
                spreads = [4 * both[c] / (n[0] + n[1]) - np.outer(mean[c], mean[c]) for c in (0, 1)]
            old, best, step = w, loss, 1.0
            way = -np.linalg.solve(curve, grad)
            if -way @ grad < 1e-6:
                return old
        w = old + step * way
        reach = [6 * math.sqrt(max(w @ spreads[c] @ w, 1e-12)) for c in (0, 1)]
        low, high = (float(f(mean[c] @ w + sign * reach[c] for c in (0, 1))) for f, sign in ((min, -1), (max, 1)))
    return old


def learn(total: Total, n_measures: int, bad_share: float) -> Model | None:
    """The model of the rows that ``total`` adds up over."""
    n = total(lambda x, good: np.array([(~good).sum(), good.sum()], float))
    if not n.all():
        return None
    # quantiles of both classes, the rarer one on a par
    at = _quantiles(total, n, n_measures, np.linspace(0, 1, RAMPS // 2 + 1))
    edges = np.sort(np.concatenate([at[1], at[0][:, 1:]], axis=1), axis=1)
    w = _weights(total, n, edges)

    def strength(x: np.ndarray) -> np.ndarray:
        return ramps(x, edges) @ w
    # rows count as often as their class among all labelled rows
    row = np.array([bad_share, 1 - bad_share]) / n
    half = float(row.min()) / 2

    def found(goal: float) -> tuple[float, float]:
        v, upto = _at_weight(total, lambda x: strength(x)[:, None], np.array([0]), row[None, :], np.array([goal]), 16)
        return float(v[0]), float(upto[0])
    cut, upto = found(bad_share - half)
    if upto < 1 - half:
        cut = (cut + found(upto + half)[0]) / 2
    slopes = 2.0 ** np.arange(-4, 5)

    def loss(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        z = np.clip(slopes[:, None] * (strength(x) - cut) + math.log(CUT / (1 - CUT)), -35, 35)
        return np.log1p(np.exp(np.where(good, -z, z))) @ np.where(good, row[1], row[0]) * n.sum()
    return Model(edges, w, cut, float(slopes[int(np.argmin(total(loss)))]))


def train(x: np.ndarray, good: np.ndarray, bad_share: float) -> Model | None:
    """``bad_share``: share of bad rows among all labelled training rows."""
    return learn(lambda block: block(x.astype(np.float32), good), x.shape[1], bad_share)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [measures(t.as_py() or b"") for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float32()))], ["id", "x"])


def _total_over(rows: DataFrame) -> Total:
    """Sums over a table of classes ``y`` and measures ``x``: whole multiples
    of 1 / ``UNIT`` for each task, so their order is of no account."""
    def total(block: Block) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for b in batches:
                if b.num_rows:
                    x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                    part = block(x, b.column(0).to_numpy(zero_copy_only=False) > 0)
                    held = part if held is None else held + part
            if held is not None:
                whole = np.rint(held * UNIT).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary())], ["part"])
        parts = rows.mapInArrow(run, "part binary").rdd.map(lambda r: np.frombuffer(bytes(r["part"]), np.int64))
        return parts.treeReduce(lambda a, b: a + b) / UNIT
    return total


def training_rows(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality") -> tuple[DataFrame | None, dict[int, int]]:
    """Class ``y`` and measures ``x`` of every labelled document outside the
    held-out fold, kept for many passes (none if there is but one class), and
    how many ids each class has among the labels."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
            .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
            .groupBy("id").agg((F.max("y") > 0).cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None, counts
    # measures, not texts, are shuffled; a repeated id counts with its least measures
    seen = (docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").cast("binary").alias("t"))
            .filter(F.col("id").isNotNull() & ~held_out(F.col("id")))
            .mapInArrow(_measured, "id long, x array<float>").groupBy("id").agg(F.min("x").alias("x")))
    parts = max(1, -(-sum(counts.values()) // TASK_ROWS))
    # the same rows in the same order in every pass, in tasks that are worth their start
    kept = cut_lineage(seen.join(rows, "id").repartition(parts, "id").sortWithinPartitions("id").select("y", "x"))
    return kept.coalesce(parts), counts


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """Fit on all labelled rows outside the held-out fold."""
    rows, counts = training_rows(docs, labels, doc_id=doc_id, text=text, label=label)
    if rows is None or rows.isEmpty():
        return None
    return learn(_total_over(rows), len(measures(b"")), counts[0] / (counts[0] + counts[1]))


def _scorer(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1)
            if model and len(texts):
                score = scores(np.array([measures(t.as_py() or b"") for t in texts]), model)
            else:
                score = np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score), pa.array((score >= CUT).astype(np.int32))],
                                             [*b.schema.names[:-1], *_OUT])
    return run


def score_documents(docs: DataFrame, model: Model | None, *, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all by default) plus ``score`` and
    ``predicted`` (score of ``CUT`` or more)."""
    bounded_batches(docs.sparkSession)
    rest = (docs if columns is None else docs.select(*columns)).drop(*_OUT)
    rows = docs.select(*rest.columns, F.col(text).cast("string").cast("binary").alias("__utf8"))
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rows.mapInArrow(_scorer(model), f"{names}, score double, predicted int")
