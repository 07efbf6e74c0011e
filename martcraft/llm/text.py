"""Words and hashes of whole Arrow string columns as numpy arrays (used inside tasks).

A word is a maximal run of bytes other than space and 0x09-0x0D; in UTF-8 these
bytes never occur inside a longer character, so splitting bytes splits text.
All arithmetic is unsigned and wraps at 64 bits.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_SEP = np.zeros(256, dtype=bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_pow: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finalizer)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    got = _pow.get(base)
    if got is None or len(got) < n:
        size = 1 << max(16, int(n).bit_length())
        steps = np.full(size, base, dtype=U)
        steps[0] = 1
        got = _pow[base] = np.multiply.accumulate(steps)
    return got[:n]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for every span, equal for equal content wherever it stands."""
    n = len(values)
    prefix = np.zeros(n + 1, dtype=U)
    np.cumsum((values.astype(U) + U(1)) * _powers(_BASE, n), out=prefix[1:])
    h = (prefix[end] - prefix[start]) * _powers(_INV, n + 1)[start]
    return mix(h + (end - start).astype(U) * U(0xD1342543DE82EF95))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive values; ``len(h) - n + 1`` of them (none if fewer)."""
    k = len(h) - n + 1
    if k <= 0:
        return np.zeros(0, dtype=U)
    g = h[:k].copy()
    for j in range(1, n):
        g *= U(0xD6E8FEB86659FD93)
        g += h[j:j + k]
    return mix(g)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the ``n + 1`` offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, off - off[0]


def binary_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The offsets and the bytes of a binary column without nulls."""
    parts = [c.cast(pa.large_binary()) for c in column.chunks if len(c)]
    offsets, data, at = [np.zeros(1, dtype=np.int64)], [np.zeros(0, dtype=np.uint8)], 0
    for c in parts:
        _, o, d = c.buffers()
        off = np.frombuffer(o, dtype=np.int64)[c.offset:c.offset + len(c) + 1]
        if off[-1] > off[0]:
            data.append(np.frombuffer(d, dtype=np.uint8)[off[0]:off[-1]])
        offsets.append(off[1:] - off[0] + at)
        at = int(offsets[-1][-1])
    return np.concatenate(offsets), np.concatenate(data)


@dataclass
class Words:
    """Words of several rows: byte spans, the row of each word, and the first word of each row."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def per_row(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of every word, of ``data`` if its bytes were changed in place (as by lower-casing)."""
        return span_hashes(self.data if data is None else data, self.start, self.end)


def words(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = _SEP) -> Words:
    n, rows = len(data), len(offsets) - 1
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return Words(data, z, z, z, np.zeros(rows + 1, dtype=np.int64))
    inside = ~sep[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(start, offsets, side="left")
    row = np.repeat(np.arange(rows), np.diff(first))
    return Words(data, start, end, row, first)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z as a-z; other bytes stay."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` with about ``limit`` bytes of ``column`` each (a longer row stands alone)."""
    if batch.num_rows == 0:
        return
    _, off = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        to = min(to, at + (1 << 16), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if len(keys) < 2:
        return np.zeros(len(keys), dtype=bool)
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if len(twice) == 0:
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def planes(a: np.ndarray) -> bytes:
    """Bytes of an array, lowest bytes of all items first, so that unused high bytes compress to nothing."""
    a = np.ascontiguousarray(a)
    return a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes()


def unplanes(b: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, dtype=np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)
