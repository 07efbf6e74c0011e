"""Document statistics and a gradient-boosted quality verdict.

``statistics`` counts words, symbols, repeated lines and repeated 5-word windows
of every whole text with numpy inside tasks. ``fit_boosted_trees`` boosts
regression trees on histograms of those statistics (logistic loss, Newton
leaves, depth-wise splits) with monotonic constraints: a split on a constrained
feature may only order its children's values the declared way, and their
subtrees stay on their sides of the midpoint. A fitted model is flattened into
node arrays, and ``score`` walks all rows down all trees by array indexing.

The training rows are a bounded sample of the labelled documents (``TRAIN_ROWS``,
chosen by a hash of the doc_id); everything else runs over all rows.

Defined cases: a null or empty text has no words and fails the base rules. Ties
at a split go to the lower feature, then the lower bound. Without labelled rows
of both classes the verdict is the base rules' alone. Repeated rows are judged
one by one, all alike; in training, rows of one doc_id count once. An empty table
gives no rows. A very long text is counted whole, in a slice of its own. Other
columns aren't read by ``judge``; ``kept_rows`` returns all of them as they are,
also where they are called like a count.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm import text as T
from martcraft.llm.tables import ship

TRAIN_ROWS = 20_000
THRESHOLD = 0.35
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_lines", "n_bytes"]
FEATURES = ["log_words", "mean_word", "symbols", "dup_lines", "repeats", "upper", "digits", "words_per_line", "symbols_per_char"]
#: More symbols, repeated lines, repeated words or capitals never raise the score.
MONOTONE = np.array([0, 0, -1, -1, -1, -1, 0, 0, -1])

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts in ``COUNTS`` for every row."""
    rows = len(offsets) - 1
    w = T.words(data, offsets)
    h = w.hashes()

    def per_row(flag: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flag) + 1, dtype=np.int64)
        np.cumsum(flag, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    out = {"n_words": w.per_row(), "n_bytes": np.diff(offsets)}
    lead = (data & 0xC0) != 0x80  # first bytes of characters
    out["word_chars"] = per_row(lead & ~T._SEP[data])
    out["n_symbols"] = per_row(_SYMBOL[data])
    out["n_upper"] = per_row((data >= 65) & (data <= 90))
    out["n_digits"] = per_row((data >= 48) & (data <= 57))

    # Lines with a word, equal to an earlier line of the row.
    newline = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offsets[:-1], newline + 1]))
    line_row = np.searchsorted(offsets, begin, side="right") - 1
    # A row's first line starts at its offset; a line after the last \n of the data's end belongs to the row that holds the \n.
    after = np.concatenate([np.zeros(rows, dtype=bool), np.ones(len(newline), dtype=bool)])
    place = np.concatenate([offsets[:-1], newline + 1])
    owner = np.concatenate([np.arange(rows), np.searchsorted(offsets, newline, side="right") - 1])
    order = np.lexsort((after, place, owner))
    begin, line_row = place[order], owner[order]
    end = np.append(begin[1:] - 1, len(data)) if len(begin) else begin
    last = np.append(line_row[1:] != line_row[:-1], True) if len(begin) else np.zeros(0, dtype=bool)
    end[last] = offsets[line_row[last] + 1]
    has_word = np.searchsorted(w.start, end) > np.searchsorted(w.start, begin)
    b, e, r = begin[has_word], end[has_word], line_row[has_word]
    key = T.span_hashes(data, b, e) ^ T.mix(r.astype(T.U))
    first = np.zeros(len(key), dtype=bool)
    first[np.unique(key, return_index=True)[1]] = True
    out["n_dup_lines"] = np.bincount(r[~first], minlength=rows)
    out["n_lines"] = np.bincount(r, minlength=rows)

    # Words inside 5-word windows that occur at least twice in the row.
    grams = T.ngrams(h, 5)
    covered = np.zeros(len(h) + 1, dtype=np.int64)
    if len(grams):
        inside = w.row[:len(grams)] == w.row[4:]
        at = np.flatnonzero(inside)
        twice = at[T.repeated(grams[at] ^ T.mix(w.row[at].astype(T.U)))]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + 5, -1)
    is_in = np.cumsum(covered[:-1]) > 0
    out["n_repeat_words"] = np.bincount(w.row[is_in], minlength=rows)
    return out


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    n = np.maximum(s["n_words"], 1)
    chars = np.maximum(s["word_chars"], 1)
    lines = np.maximum(s["n_lines"], 1)
    return np.stack([
        np.log1p(s["n_words"]), s["word_chars"] / n, s["n_symbols"] / n, s["n_dup_lines"] / lines, s["n_repeat_words"] / n,
        s["n_upper"] / chars, s["n_digits"] / chars, s["n_words"] / lines, s["n_symbols"] / chars], axis=1)


@dataclass(frozen=True)
class Trees:
    """All trees of a model as node arrays; a leaf points to itself, so ``depth`` steps reach one."""

    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 for every row; a value up to the bound goes left."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.bound[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit_boosted_trees(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, rounds: int = 60, depth: int = 4,
                      rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: int = 10) -> Trees:
    """Boosted trees for labels 0/1 with monotonic constraints (-1, 0, 1 per feature)."""
    m = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(m)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    feature, bound, left, right, value, roots = [], [], [], [], [], []

    def node(v: float) -> int:
        i = len(feature)
        feature.append(0)
        bound.append(np.inf)
        left.append(i)
        right.append(i)
        value.append(v)
        return i

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, hess = y - p, p * (1 - p)
        roots.append(node(0.0))
        work = [(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf)]
        while work:
            i, rows, level, low, high = work.pop()
            sg, sh = g[rows].sum(), hess[rows].sum()
            own = float(np.clip(sg / (sh + ridge), low, high))
            value[i] = rate * own
            if level == depth or len(rows) < 2 * least:
                margin[rows] += value[i]
                continue
            best = None
            for f in range(m):
                b = binned[rows, f]
                size = len(edges[f]) + 1
                cg, ch = np.cumsum(np.bincount(b, g[rows], size))[:-1], np.cumsum(np.bincount(b, hess[rows], size))[:-1]
                cn = np.cumsum(np.bincount(b, minlength=size))[:-1]
                vl, vr = np.clip(cg / (ch + ridge), low, high), np.clip((sg - cg) / (sh - ch + ridge), low, high)
                gain = sum(2 * a * v - (c + ridge) * v * v for a, v, c in ((cg, vl, ch), (sg - cg, vr, sh - ch)))
                ok = (cn >= least) & (len(rows) - cn >= least) & (monotone[f] * (vr - vl) >= 0)
                if ok.any():
                    k = int(np.argmax(np.where(ok, gain, -np.inf)))
                    if best is None or gain[k] > best[0]:
                        best = (gain[k], f, k, vl[k], vr[k])
            if best is None or best[0] - (2 * sg * own - (sh + ridge) * own * own) < 1e-6:
                margin[rows] += value[i]
                continue
            _, f, k, vl, vr = best
            go = binned[rows, f] <= k
            a, b = node(0.0), node(0.0)
            feature[i], bound[i], left[i], right[i] = f, float(edges[f][k]), a, b
            mid = (vl + vr) / 2
            sides = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[int(monotone[f])]
            work += [(a, rows[go], level + 1, *sides[0]), (b, rows[~go], level + 1, *sides[1])]
    return Trees(np.array(feature), np.array(bound), np.array(left), np.array(right), np.array(value), np.array(roots), depth, base)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every row."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, "text"):
                got = statistics(*T.utf8(s.column("text")))
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), *(pa.array(got[c], pa.int64()) for c in COUNTS)], names=["doc_id", *COUNTS])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        count, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          train_rows: int = TRAIN_ROWS) -> Trees | None:
    """A model fitted on at most ``train_rows`` labelled documents, or None without both classes.

    Of rows with one doc_id the one with the least counts is used (compared in
    the order of ``COUNTS``), so the model doesn't depend on how the rows are dealt.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label_col).alias("y"))
    pick = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(pick), "doc_id")
    one = document_statistics(rows.select("doc_id", "text")).groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("least")).select("doc_id", "least.*")
    stats = one.join(F.broadcast(pick), "doc_id")
    t = stats.orderBy("doc_id").toPandas()
    if t["y"].nunique() < 2:
        return None
    counts = {c: t[c].to_numpy() for c in COUNTS}
    return fit_boosted_trees(features(counts), t["y"].to_numpy(dtype=float), MONOTONE)


def verdicts(column: pa.Array, model: Trees | None, threshold: float) -> dict[str, np.ndarray]:
    """Counts, ``base_failed``, ``quality_score`` and ``kept`` of the texts of a column."""
    got = statistics(*T.utf8(column))
    n = got["n_words"]
    got["base_failed"] = (n < 10) | (100 * got["n_repeat_words"] > 20 * n)
    got["quality_score"] = np.ones(len(n)) if model is None else model.score(features(got))
    got["kept"] = ~got["base_failed"] & (got["quality_score"] >= threshold)
    return got


def judge(docs: DataFrame, model: Trees | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``quality_score`` and ``kept`` of every row.

    A row fails the base rules with fewer than 10 words, or if over a fifth of its
    words lie in repeated 5-word windows. Others are kept if the model gives
    class 1 at least the probability ``threshold``.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    names = [*COUNTS, "base_failed", "quality_score", "kept"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, "text"):
                got = verdicts(s.column("text"), shared.value, threshold)
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), *(pa.array(got[c]) for c in names)], names=["doc_id", *names])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        score, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, quality_score double, kept boolean")


def kept_rows(docs: DataFrame, model: Trees | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns, whatever these are called."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, text_col):
                yield s.filter(pa.array(verdicts(s.column(text_col), shared.value, threshold)["kept"]))

    return docs.mapInArrow(keep, docs.schema)
