"""Toxicity by classifier chains.

A text's features are its distinct lower-case letter runs and their stems (first
six bytes), once, twice or more, and densely, by 64-bit hash. The categories are predicted one after the other by logistic models; each model
also gets the logits of all earlier categories. In training those come out of
fold: a category's probability for a row is given by a model fitted without the
row's fold, so later models meet earlier predictions as uncertain as they will
be in use. Folds go by the hash of the text, so copies of a text share a fold.

Every fit chooses its features on its own rows (the ``MAX_FEATURES`` with the
largest two-proportion z), and its loss is minimised by full-batch Adam with a
ridge. The training rows are a bounded sample of the labelled documents
(``TRAIN_ROWS``, by a hash of the doc_id); all documents are scored, whole.

Defined cases: a null or empty text has no features and gets the models'
intercepts. A category without rows of both classes gets its constant share.
Labels other than 0 and 1 don't count. Repeated rows are scored one by one, all
alike; in training, rows of one doc_id count once. An empty table of documents
gives no rows; without labelled rows every probability is a half. Very long texts
are cut into terms in slices of a few MB between documents, never inside one.
Other columns, whatever they are called, aren't read and aren't returned.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.llm import text as T
from martcraft.llm.tables import ship

TRAIN_ROWS = 10_000
LEAST = 4
MAX_FEATURES = 1500
FOLDS = 4

_NOT_LETTER = np.ones(256, dtype=bool)
_NOT_LETTER[97:123] = False
_NOT_LETTER[128:] = False


STEM = 6
DENSE = 150


def distinct_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct features of every row, row after row, and the rows' offsets.

    A term is a letter run, or its first ``STEM`` bytes. It gives one feature, a
    second one if it occurs twice or more, and a third if it is at least every
    ``DENSE``-th word.
    """
    low = T.lower_ascii(data)
    w = T.words(low, offsets, _NOT_LETTER)
    long = np.flatnonzero(w.end - w.start >= STEM)
    stems = T.mix(T.span_hashes(low, w.start[long], w.start[long] + STEM))
    h, row = np.concatenate([w.hashes(), stems]), np.concatenate([w.row, w.row[long]])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(h)))
    h, row = h[at], row[at]
    often = n > 1
    dense = n * DENSE >= w.per_row()[row]
    h = np.concatenate([h, T.mix(h[often] + T.U(1)), T.mix(h[dense] + T.U(2))])
    row = np.concatenate([row, row[often], row[dense]])
    order = np.argsort(row, kind="stable")
    h, row = h[order], row[order]
    return h, np.searchsorted(row, np.arange(len(offsets)))


@dataclass(frozen=True)
class Linear:
    terms: np.ndarray  # sorted hashes
    weights: np.ndarray
    earlier: np.ndarray  # weights of the earlier categories' logits
    bias: float

    def logits(self, h: np.ndarray, off: np.ndarray, before: np.ndarray) -> np.ndarray:
        out = np.full(len(off) - 1, self.bias) + before @ self.earlier
        if len(self.terms) and len(h):
            at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
            hit = np.flatnonzero(self.terms[at] == h)
            row = np.searchsorted(off, hit, side="right") - 1
            out += np.bincount(row, self.weights[at[hit]], minlength=len(out))
        return out


def fit_linear(h: np.ndarray, off: np.ndarray, rows: np.ndarray, y: np.ndarray, before: np.ndarray, ridge: float = 1.0, steps: int = 250) -> Linear:
    """A logistic model of ``y[rows]``; ``before`` has the earlier logits of all rows."""
    use = np.zeros(len(off) - 1, dtype=bool)
    use[rows] = True
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    mine = use[row]
    terms, code = np.unique(h[mine], return_inverse=True)
    row = row[mine]
    yy = y[rows].astype(float)
    pos, neg = yy.sum(), len(yy) - yy.sum()
    share = np.clip(yy.mean() if len(yy) else 0.5, 1e-4, 1 - 1e-4)
    bias = float(np.log(share / (1 - share)))
    if not pos or not neg:
        return Linear(np.zeros(0, dtype=T.U), np.zeros(0), np.zeros(before.shape[1]), bias)
    in_pos = np.bincount(code, y[row], minlength=len(terms))
    in_all = np.bincount(code, minlength=len(terms))
    mean = in_all / len(yy)
    z = (in_pos / pos - (in_all - in_pos) / neg) / np.sqrt(mean * (1 - mean) * (1 / pos + 1 / neg) + 1e-12)
    z[in_all < LEAST] = 0
    best = np.sort(np.argsort(-np.abs(z), kind="stable")[:MAX_FEATURES])
    best = best[z[best] != 0]
    slot = np.full(len(terms), -1)
    slot[best] = np.arange(len(best))
    keep = slot[code] >= 0
    back = np.full(len(off) - 1, -1)
    back[rows] = np.arange(len(rows))
    r, c = back[row[keep]], slot[code[keep]]
    b = before[rows]
    n, k = len(best), before.shape[1]
    theta, m, v = np.zeros(n + k + 1), np.zeros(n + k + 1), np.zeros(n + k + 1)
    theta[-1] = bias
    for t in range(1, steps + 1):
        margin = theta[-1] + b @ theta[n:n + k] + np.bincount(r, theta[c], minlength=len(rows))
        err = 1 / (1 + np.exp(-margin)) - yy
        grad = np.concatenate([np.bincount(c, err[r], minlength=n), b.T @ err, [err.sum()]])
        grad[:-1] += ridge * theta[:-1]
        grad /= len(rows)
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        theta -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-10)
    return Linear(terms[best], theta[:n], theta[n:n + k], float(theta[-1]))


@dataclass(frozen=True)
class Chain:
    categories: list[str]
    models: list[Linear]
    thresholds: list[float]

    def probabilities(self, h: np.ndarray, off: np.ndarray) -> np.ndarray:
        logits = np.zeros((len(off) - 1, 0))
        for model in self.models:
            logits = np.column_stack([logits, model.logits(h, off, logits)])
        return 1 / (1 + np.exp(-logits))


def fit_chain(h: np.ndarray, off: np.ndarray, labels: np.ndarray, folds: np.ndarray, categories: list[str]) -> Chain:
    """``labels``: rows x categories, 0/1. Thresholds have the best F1 on the out-of-fold predictions."""
    logits = np.zeros((len(labels), 0))
    models, thresholds = [], []
    rows = np.arange(len(labels))
    for c in range(len(categories)):
        y = labels[:, c]
        out = np.zeros(len(labels))
        for f in np.unique(folds):
            inside = folds == f
            model = fit_linear(h, off, rows[~inside], y, logits) if (~inside).any() else fit_linear(h, off, rows, y, logits)
            out[inside] = model.logits(h, off, logits)[inside]
        models.append(fit_linear(h, off, rows, y, logits))
        p = 1 / (1 + np.exp(-out))
        tries = np.linspace(0.3, 0.7, 9)
        f1 = [2 * (y * (p >= t)).sum() / max(1, y.sum() + (p >= t).sum()) for t in tries]
        thresholds.append(float(tries[int(np.argmax(f1))]))
        logits = np.column_stack([logits, out])
    return Chain(categories, models, thresholds)


def train_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str = "doc_id", text_col: str = "text",
                train_rows: int = TRAIN_ROWS) -> Chain:
    """A chain over ``categories`` (name: 0/1 expression over ``labels``), in their order.

    Of rows with one doc_id the one with the least list of term hashes is used
    (compared byte by byte), so the models don't depend on how the rows are dealt.
    """
    ship(docs.sparkSession)
    names = list(categories)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *(e.cast("int").alias(f"y{i}") for i, e in enumerate(categories.values())))
    ok = F.col("doc_id").isNotNull()
    for i in range(len(names)):
        ok = ok & F.col(f"y{i}").isin(0, 1)
    known = known.where(ok).groupBy("doc_id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))))
    pick = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(pick, "doc_id")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, "text"):
                h, off = distinct_terms(*T.utf8(s.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), pa.array([h[i:j].tobytes() for i, j in zip(off[:-1], off[1:], strict=True)], pa.binary()),
                     *(s.column(f"y{i}") for i in range(len(names)))], names=["doc_id", "terms", *(f"y{i}" for i in range(len(names)))])

    ys = [f"y{i}" for i in range(len(names))]
    got = rows.mapInArrow(terms, "doc_id long, terms binary, " + ", ".join(f"{y} int" for y in ys)).groupBy("doc_id", *ys).agg(F.min("terms").alias("terms"))
    t = got.toArrow().sort_by("doc_id")
    cut, data = T.binary_bytes(t.column("terms"))
    h, off = data.view(T.U), cut // 8
    y = np.column_stack([t.column(f"y{i}").to_numpy() for i in range(len(names))])
    sums = np.append(T.U(0), np.cumsum(h, dtype=T.U))
    folds = (T.mix(sums[off[1:]] - sums[off[:-1]]) % T.U(FOLDS)).astype(np.int64)
    h, off = _frequent(h, off)
    return fit_chain(h, off, y, folds, names)


def _frequent(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the features of fewer than ``LEAST`` rows, most of them, which no fit would choose."""
    s = np.sort(h)
    begin = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, dtype=np.int64)
    known = s[begin][np.diff(np.append(begin, len(s))) >= LEAST]
    del s
    if not len(known):
        return np.zeros(0, dtype=T.U), np.zeros_like(off)
    keep = np.zeros(len(h), dtype=bool)
    for i in range(0, len(h), 1 << 20):
        part = h[i:i + (1 << 20)]
        keep[i:i + (1 << 20)] = known[np.minimum(np.searchsorted(known, part), len(known) - 1)] == part
    return h[keep], np.append(0, np.cumsum(keep))[off]


def score_toxicity(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``p_<category> double`` and ``is_<category> boolean`` for every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories] + [f"is_{c}" for c in chain.categories]
    types = ["double"] * len(chain.categories) + ["boolean"] * len(chain.categories)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = np.array(shared.value.thresholds)
        for batch in batches:
            for s in T.slices(batch, "text"):
                p = shared.value.probabilities(*distinct_terms(*T.utf8(s.column("text"))))
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), *(pa.array(x) for x in p.T), *(pa.array(x) for x in (p >= limits).T)], names=["doc_id", *names])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        score, "doc_id long, " + ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))
