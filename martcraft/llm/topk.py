"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers and packed into blocks of rows; in a block
every attribute is a stack of bitmaps, one per binary digit, a bit per row. The
score of all rows against a batch of queries is a sum of attribute slices: each
slice counts where the query's digit is set, complemented where the query's
component is negative, and carry-save adders on whole bitmaps add them up. The
sum is again a stack of slices, so the best rows are found from the most
significant slice downward: rows that must be in, rows still equal, until the
slices end. Rows equal at the boundary are resolved by the smaller id, and the
chosen rows' scores are computed again from the integers.

Queries are a part of the rows (by default those whose id is divisible by 100);
blocks of queries meet blocks of rows in tasks that each hold one pair of
blocks. A pair of blocks yields at most k rows per query, and the last step
ranks those.

Defined cases: a vector that is null or has null or non-finite components takes
no part, nor does a row without an id. Vectors of different lengths aren't
compared. An id that stands on several rows is a candidate on each, but never
for its own query; a query's rows with one id and different vectors are separate
queries only in the candidates' ranking of that id (the ranks run on). Fewer
than k candidates: all of them. Components are integers of any size: those beyond 32
bits travel as doubles, which hold them exactly, and are counted by Python's
integers where 64 bits might not do. Only a component that is infinite after scaling,
or a result's score that doesn't fit a long, raises an error. Repeated rows are rows
each; an empty table gives an empty one; other columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm import text as T
from martcraft.llm.tables import saved, ship

ROWS = 4096
QUERIES = 128
_ALL = T.U(0xFFFFFFFFFFFFFFFF)


def bitmaps(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words, the first row in the lowest bit."""
    pad = (-bits.shape[-1]) % 64
    bits = np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, pad)])
    return np.packbits(bits, axis=-1, bitorder="little").view(T.U)


class Sum:
    """Adds bitmaps of given binary weights; a carry-save adder turns three of one weight into one and a carry."""

    def __init__(self, shape: tuple[int, int]):
        self.shape = shape
        self.waiting: dict[int, list[np.ndarray]] = {}
        self.spare: list[np.ndarray] = []

    def buffer(self) -> np.ndarray:
        return self.spare.pop() if self.spare else np.empty(self.shape, dtype=T.U)

    def add(self, weight: int, x: np.ndarray) -> None:
        while True:
            have = self.waiting.setdefault(weight, [])
            if len(have) < 2:
                have.append(x)
                return
            a, b = have.pop(), have.pop()
            both, half = self.buffer(), a
            np.bitwise_and(a, b, out=both)
            np.bitwise_xor(a, b, out=half)
            np.bitwise_and(half, x, out=b)
            np.bitwise_or(b, both, out=b)  # the carry
            np.bitwise_xor(half, x, out=half)
            have.append(half)
            self.spare += [both, x]
            weight, x = weight + 1, b

    def slices(self) -> list[np.ndarray]:
        """The total, a bitmap per binary digit from the lowest."""
        out, at = [], 0
        while at <= max(self.waiting, default=-1):
            have = self.waiting.get(at, [])
            if len(have) == 2:
                a, b = have
                self.waiting[at] = []
                carry = a & b
                out.append(a ^ b)
                self.add(at + 1, carry)
            else:
                out.append(have[0] if have else np.zeros(self.shape, dtype=T.U))
            at += 1
        return out


def top_rows(values: np.ndarray, queries: np.ndarray, allowed: np.ndarray, k: int) -> list[np.ndarray]:
    """For each query the places of its ``k`` best allowed rows, ties to earlier rows. ``allowed``: booleans, queries x rows."""
    low = values.min()
    unsigned = values - low
    digits = max(1, int(unsigned.max()).bit_length())
    size = np.abs(queries)
    q_digits = max(1, int(size.max()).bit_length())
    negative = np.where(queries < 0, _ALL, T.U(0))
    shape = (len(queries), -(-len(values) // 64))
    total = Sum(shape)
    masks = [np.where((size >> j) & 1, _ALL, T.U(0)) for j in range(q_digits)]
    used = [np.flatnonzero(m.any(axis=0)) for m in masks]
    used = [set(u.tolist()) for u in used]
    for d in range(values.shape[1]):
        for b in range(digits):
            column = bitmaps(((unsigned[:, d] >> b) & 1).astype(bool))
            x = column[None, :] ^ negative[:, d, None]
            for j in range(q_digits):
                if d in used[j]:
                    y = total.buffer()
                    np.bitwise_and(x, masks[j][:, d, None], out=y)
                    total.add(b + j, y)
    equal = bitmaps(allowed)
    sure = np.zeros(shape, dtype=T.U)
    for s in reversed(total.slices()):
        more = sure | (equal & s)
        many = (np.bitwise_count(more).sum(axis=1, dtype=np.int64) > k)[:, None]
        sure = np.where(many, sure, more)
        equal &= np.where(many, s, ~s)
    out = []
    for g, e in zip(sure, equal, strict=True):
        have = np.flatnonzero(np.unpackbits(g.view(np.uint8), bitorder="little"))
        ties = np.flatnonzero(np.unpackbits(e.view(np.uint8), bitorder="little"))
        out.append(np.append(have, ties[:k - len(have)]))
    return out


def integers(raw: bytes, n: int) -> np.ndarray:
    """``n`` rows of integers, as 64-bit ones if differences of them fit those."""
    if raw[:1] == WIDE:
        x = np.frombuffer(raw[1:], dtype=np.float64).reshape(n, -1)
        if np.abs(x).max(initial=0) < 1 << 61:
            return x.astype(np.int64)
        return np.array([[int(c) for c in row] for row in x.tolist()], dtype=object).reshape(x.shape)
    return np.frombuffer(raw[1:], dtype=np.int32).reshape(n, -1).astype(np.int64)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row; one that doesn't fit a long raises."""
    if a.dtype != object and b.dtype != object:
        most = [int(np.abs(x).max(initial=0)) for x in (a, b)]
        if most[0] * most[1] * max(1, a.shape[1]) < 1 << 63:
            return np.einsum("ij,ij->i", a, b)
    total = [sum(x * y for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
    if any(not -(1 << 63) <= t < 1 << 63 for t in total):
        raise OverflowError("a score doesn't fit a long")
    return np.array(total, dtype=np.int64)


NARROW, WIDE = b"i", b"d"
_PACK = pa.schema([("part", pa.int64()), ("dim", pa.int64()), ("ids", pa.binary()), ("vals", pa.binary())])


def _packed(limit: int):
    def pack(t: pa.Table) -> pa.Table:
        part, dim = t.column("part")[0].as_py(), t.column("dim")[0].as_py()
        ids = t.column("id").to_numpy()
        vals = t.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
        vals = np.floor(vals) + 0.0
        wide = np.abs(vals).max(initial=0) >= 1 << 31
        code = (lambda x: WIDE + x.tobytes()) if wide else lambda x: NARROW + x.astype(np.int32).tobytes()
        order = np.lexsort((*vals.T[::-1], ids)) if dim else np.argsort(ids)
        rows = [order[i:i + limit] for i in range(0, len(order), limit)]
        return pa.table({"part": [part] * len(rows), "dim": [dim] * len(rows), "ids": [ids[r].tobytes() for r in rows],
                         "vals": [code(vals[r]) for r in rows]}, schema=_PACK)

    return pack


def top_k(vectors: DataFrame, k: int = 10, scale: int = 1024, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id long, rank int, vec_id long, score long``: the best ``k`` rows for each id divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: c * scale)
    ints = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), x.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull() & finite)
    ints = ints.select("id", "v", F.size("v").cast("long").alias("dim"))
    ints = ints.where(F.when(F.exists("v", lambda c: F.abs(c) == float("inf")), F.raise_error(F.lit("a component is infinite after scaling"))).isNull())
    asked = F.col("id") % every == 0
    n, nq = ints.agg(F.count("*"), F.count_if(asked)).first()
    parts, q_parts = max(1, -(-n // ROWS)), max(1, -(-nq // QUERIES))

    def packs(df: DataFrame, m: int, limit: int, name: str) -> DataFrame:
        dealt = df.withColumn("part", F.pmod(F.xxhash64("id", "v"), F.lit(m)).cast("long"))
        return saved(dealt.groupBy("part", "dim").applyInArrow(_packed(limit), "part long, dim long, ids binary, vals binary"), name)

    rows = packs(ints, parts, ROWS, "rows")
    queries = packs(ints.where(asked), q_parts, QUERIES, "queries")
    rows = rows.withColumn("q_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_parts - 1).cast("long"))))
    queries = queries.select(F.col("part").alias("q_part"), "dim", F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals"),
                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, q_ids = np.frombuffer(r["ids"], dtype=np.int64), np.frombuffer(r["q_ids"], dtype=np.int64)
                vals, q_vals = integers(r["vals"], len(ids)), integers(r["q_vals"], len(q_ids))
                allowed = ids[None, :] != q_ids[:, None]
                if vals.shape[1]:
                    chosen = top_rows(vals, q_vals, allowed, k)
                else:  # vectors of no components score 0 with each other
                    chosen = [np.flatnonzero(a)[:k] for a in allowed]
                at = np.repeat(np.arange(len(q_ids)), [len(c) for c in chosen])
                to = np.concatenate(chosen).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[at]), pa.array(ids[to]), pa.array(scores(q_vals[at], vals[to]))], names=["query_id", "vec_id", "score"])

    found = rows.join(queries, ["q_part", "part", "dim"]).select("ids", "vals", "q_ids", "q_vals").mapInArrow(best, "query_id long, vec_id long, score long")
    ranked = found.selectExpr("*", "row_number() over (partition by query_id order by score desc, vec_id) as rank").where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
