"""Periodic runs of words by string synchronising sets.

A run is a stretch of words whose smallest period q fits at least ``exponent``
times (three or more) and that no neighbouring word extends.

At each scale t = 4, 8, 16, ... a position is selected if, of the hashes of the
``t``-word windows that start at it or up to ``t`` behind it, the smallest one is
that of the first or the last; windows with a period of t / 3 or less are left out.
So whether a position is selected depends on its context, the next ``2 t`` words,
alone. A run with period q in [1.5 t, 3 t) and length 3 q or more has a selected
position i whose context and that of i + q lie inside the run: otherwise two
periods of it would have a period of t / 3 or less, and with it the whole run, so
q wouldn't be its smallest period. Both contexts are equal, so positions of one
document with equal contexts less than 3 t apart (equal ones are more than t / 3
apart, so a position has few of them) propose their distance as a period.

Proposals are tested word by word in a stretch around them; proposals of one period
whose stretches meet are tested together. The stretch reaches beyond the gap that
two selected positions of a run can have, so a run that isn't closed inside it has
a smaller period. What is found at one scale tells the windows with small periods
of the later ones. Periods below 6 are omitted by all scales: their regions are
detected separately, by comparing each word with the one q places on.

All documents of a slice are worked on at once, one after the other, with a
separator of its own behind each; scales too long for a document leave it out.

Defined cases: words are split at bytes 0x20 and 0x09-0x0D and compared by 64-bit
hashes. A null or wordless text has no words and no run; its collapsed text is
empty. Rows with a null id, repeated ids and repeated rows are rows like any other.
An empty table gives an empty one; other columns of ``docs`` are not looked at. A
task's memory follows its longest text.
"""
from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm import text as T
from martcraft.llm.tables import ship

FIRST_SCALE = 4
CHUNK = 1 << 21
_ROWS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _true_runs(ok: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the stretches of true values; no stretch goes over a place in ``first``."""
    edge = np.flatnonzero(np.diff(ok, prepend=False, append=False))
    if first is None or not len(first):
        return edge[::2], edge[1::2]
    inner = first[ok[first] & ok[first - 1]]
    both = np.sort(np.concatenate([edge, inner, inner]))
    return both[::2], both[1::2]


class Runs:
    """Rows of words with a separator behind each row, and the runs found in them so far."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray):
        rows = len(offsets) - 1
        size = np.diff(offsets)
        self.size = size + 1
        self.x = np.insert(words, offsets[1:], T.mix(np.arange(rows).astype(T.U) ^ T.U(0xA076_1D64_78BD_642F)))
        self.live = np.arange(rows)
        self.found: list[np.ndarray] = []  # of (row, start, end, period)
        self._place()

    def _place(self) -> None:
        self.begin = np.append(0, np.cumsum(self.size))[:-1]
        self.row = np.repeat(np.arange(len(self.size)), self.size)

    def keep(self, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Go on with some rows only; returns their part of ``ids``."""
        at = np.repeat(rows, self.size)
        self.x, self.live, self.size = self.x[at], self.live[rows], self.size[rows]
        self._place()
        return ids[at]

    def _add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        row = self.row[start]
        self.found.append(np.stack([self.live[row], start - self.begin[row], end - self.begin[row], period], axis=1))

    def small(self, top: int) -> None:
        """Runs with a period below ``top``."""
        for q in range(1, top):
            s, e = _true_runs(self.x[:-q] == self.x[q:])
            long = e - s >= 2 * q
            if long.any():
                self._add(s[long], e[long] + q, np.full(int(long.sum()), q))

    def periodic(self, t: int) -> np.ndarray:
        """Which windows of ``t`` words have a period of t / 3 or less."""
        n = len(self.x)
        step = np.zeros(n + 1, dtype=np.int32)
        if self.found:
            r = np.concatenate(self.found)
            r = r[(3 * r[:, 3] <= t) & (r[:, 2] - r[:, 1] >= t)]
            at = np.searchsorted(self.live, r[:, 0])
            here = at < len(self.live)
            here[here] = self.live[at[here]] == r[here, 0]
            r, at = r[here], at[here]
            np.add.at(step, self.begin[at] + r[:, 1], 1)
            np.add.at(step, self.begin[at] + r[:, 2] - t + 1, -1)
        return np.cumsum(step[:n]) > 0

    def selected(self, ids: np.ndarray, t: int) -> np.ndarray:
        """The synchronising set; ``ids`` are the hashes of the windows of ``t`` words."""
        n = len(ids)
        never = np.iinfo(T.U).max
        ids = np.where(self.periodic(t), never, ids)
        least, span = ids, 1
        while span < t:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if n <= 2 * t:
            return np.zeros(0, dtype=np.int64)
        first, last = ids[:n - t], ids[t:]
        least = np.minimum(least[:n - t], last)
        picked = np.flatnonzero(((least == first) | (least == last)) & (least != never))
        inside = picked - self.begin[self.row[picked]] + 2 * t < self.size[self.row[picked]]
        return picked[inside]

    def scale(self, t: int, ids: np.ndarray, contexts: np.ndarray) -> None:
        """Runs with periods from 1.5 t on and below 3 t."""
        at = self.selected(ids, t)
        if not len(at):
            return
        key = T.mix(contexts[at] + self.row[at].astype(T.U) * T.U(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        starts, periods = [], []
        k = 1
        while k < len(at):
            near = (key[k:] == key[:-k]) & (at[k:] - at[:-k] < 3 * t)
            if not near.any():
                break
            d = (at[k:] - at[:-k])[near]
            i = at[:-k][near]
            use = (2 * d >= 3 * t) & (3 * d < self.size[self.row[i]])
            starts.append(i[use])
            periods.append(d[use])
            k += 1
        if starts:
            self._test(np.concatenate(starts), np.concatenate(periods), 4 * t + 4)

    def _test(self, at: np.ndarray, d: np.ndarray, reach: int) -> None:
        if not len(at):
            return
        order = np.lexsort((at, d))
        at, d = at[order], d[order]
        row = self.row[at]
        begin, end = self.begin[row], self.begin[row] + self.size[row] - 1 - d  # compared places
        lo, hi = np.maximum(at - reach, begin), np.minimum(at + reach, end)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (d[1:] != d[:-1]) | (lo[1:] > hi[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        lo, hi, d, begin, end = lo[first], hi[last], d[first], begin[first], end[first]
        size = hi - lo
        i = 0
        while i < len(lo):
            total = np.cumsum(size[i:])
            j = i + max(1, int(np.searchsorted(total, CHUNK, side="right")))
            if j == i + 1:
                base, q = 0, int(d[i])
                s, e = _true_runs(self.x[lo[i]:hi[i]] == self.x[lo[i] + q:hi[i] + q])
                seg = np.full(len(s), i)
                s, e = s + lo[i], e + lo[i]
            else:
                base = np.append(0, total[:j - i - 1])
                shift = lo[i:j] - base
                place = np.arange(total[j - i - 1]) + np.repeat(shift, size[i:j])
                same = self.x[place] == self.x[place + np.repeat(d[i:j], size[i:j])]
                s, e = _true_runs(same, base[1:])
                seg = np.searchsorted(base, s, side="right") - 1
                s, e = s + shift[seg], e + shift[seg]
                seg = seg + i
            closed = ((s > lo[seg]) | (s == begin[seg])) & ((e < hi[seg]) | (e == end[seg])) & (e - s >= 2 * d[seg])
            if closed.any():
                self._add(s[closed], (e + d[seg])[closed], d[seg][closed])
            i = j


def word_runs(words: np.ndarray, offsets: np.ndarray, min_length: int = 24, exponent: int = 3) -> np.ndarray:
    """``(row, start, length, period)`` of every run, by row, start and period; ``words`` are hashes."""
    if exponent < 3:
        raise ValueError("runs of less than three periods are not found by this method")
    if not len(words):
        return np.zeros((0, 4), dtype=np.int64)
    r = Runs(words.astype(T.U), offsets)
    r.small(FIRST_SCALE * 3 // 2)
    ids = T.mix(r.x)

    def joined(ids: np.ndarray, t: int) -> np.ndarray:
        after = np.concatenate([ids[t:], np.repeat(ids[-1:], min(t, len(ids)))])
        return T.mix(ids * T.U(0xD6E8FEB86659FD93) + after)

    t = 1
    while True:
        if t >= FIRST_SCALE:
            rows = 2 * (r.size - 1) >= 9 * t
            if not rows.any():
                break
            if not rows.all():
                ids = r.keep(rows, ids)
            contexts = joined(ids, t)
            r.scale(t, ids, contexts)
            ids = contexts
        else:
            ids = joined(ids, t)
        t *= 2
    if not r.found:
        return np.zeros((0, 4), dtype=np.int64)
    f = np.concatenate(r.found)
    f = f[np.lexsort((f[:, 3], f[:, 2], f[:, 1], f[:, 0]))]
    new = np.ones(len(f), dtype=bool)
    new[1:] = (f[1:, :3] != f[:-1, :3]).any(axis=1)  # a multiple of a period has the same bounds
    f = f[new]
    f[:, 2] -= f[:, 1]
    f = f[f[:, 2] >= np.maximum(min_length, exponent * f[:, 3])]
    return f[np.lexsort((f[:, 3], f[:, 1], f[:, 0]))]


def _strongest(runs: np.ndarray) -> tuple[int, int, int]:
    """Start, length and period of the run with the greatest length / period; ties: smallest start, then period."""
    size = runs[:, 2] / runs[:, 3]
    best = runs[size >= size.max() * (1 - 1e-12)].tolist()
    return tuple(min(best, key=lambda r: (-Fraction(r[2], r[3]), r[1], r[3]))[1:])


def _collapsed(w: T.Words, runs: np.ndarray) -> pa.Array:
    """Per row the words that no run holds behind its first period, joined by one space."""
    step = np.zeros(len(w) + 1, dtype=np.int64)
    first = w.first[runs[:, 0]] + runs[:, 1]
    np.add.at(step, first + runs[:, 3], 1)
    np.add.at(step, first + runs[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(step[:len(w)]) == 0)
    row = w.row[kept]
    more = np.append(row[1:] == row[:-1], False) if len(row) else np.zeros(0, dtype=bool)  # a space follows
    size = w.end[kept] - w.start[kept] + more
    off = np.append(0, np.cumsum(size))
    place = np.arange(off[-1]) + np.repeat(w.start[kept] - off[:-1], size)
    out = w.data[place]
    out[off[1:][more] - 1] = 32
    rows = off[np.searchsorted(row, np.arange(len(w.first)))]
    return pa.LargeStringArray.from_buffers(len(rows) - 1, pa.py_buffer(rows.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes()))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24, exponent: int = 3) -> DataFrame:
    """One row per input row: ``doc_id long, n_runs long, start, length, period, exponent_milli long`` of the
    strongest run (null without runs), ``runs array<struct<start, length, period>>`` by start and period, and
    ``collapsed string``, the words that no run holds behind its first period, joined by one space.
    """
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, "text"):
                w = T.words(*T.utf8(s.column("text")))
                runs = word_runs(w.hashes(), w.first, min_length, exponent)
                cut = np.searchsorted(runs[:, 0], np.arange(s.num_rows + 1))
                best = [_strongest(runs[i:j]) if j > i else (None, None, None) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                flat = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([
                    s.column("id"), pa.array(np.diff(cut)), *(pa.array([b[c] for b in best], pa.int64()) for c in range(3)),
                    pa.array([None if b[0] is None else 1000 * b[1] // b[2] for b in best], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), flat).cast(_ROWS), _collapsed(w, runs).cast(pa.string()),
                ], names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        rows, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs array<struct<start: long, length: long, period: long>>, collapsed string")
