"""Connected components of a graph given as a table of edges."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm.tables import dropped, saved, ship


HELD = 500_000
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _contract(batches: Iterator[pa.RecordBatch], whole: bool = False) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a task, ``HELD`` nodes at a time, by a star per component of theirs.

    ``whole``: centres get a row too.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def stars() -> pa.RecordBatch:
        found = [(x, r) for x in list(parent) if (r := find(x)) != x or whole]
        parent.clear()
        return pa.RecordBatch.from_pydict({"a": [x for x, _ in found], "b": [r for _, r in found]}, schema=_PAIR)

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > HELD:
            yield stars()
    yield stars()


def _contract_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in _contract(batches, whole=True):
        yield rb.rename_columns(["node", "component"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of an edge; the component is its smallest node.

    ``edges`` has two long columns. Tasks contract their edges to stars, then once
    more in as few tasks as hold ``HELD`` nodes each; if that is one, its stars are
    the components. Else each round turns stars to ever smaller centres: every node's
    larger neighbours go to the smallest neighbour, then its smaller ones do (the
    alternating star algorithm; its rounds grow with the logarithm of the size). A
    node's neighbours are reduced by a partial aggregate, and the join back may be
    split where one centre has many rows. Loops, repeated edges and null ends are
    ignored; an empty table gives none.
    """
    ship(edges.sparkSession)
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")
    e = saved(e.mapInArrow(_contract, "a long, b long"), "edges")
    tasks = -(-2 * e.count() // HELD)
    if tasks <= 1:
        return e.coalesce(1).mapInArrow(_contract_whole, "node long, component long")
    was_at = e
    fewer = saved(e.coalesce(tasks).mapInArrow(_contract, "a long, b long").distinct(), "edges")
    dropped(e)
    e = fewer

    def mark(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    was = mark(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        new = saved(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        dropped(e)
        e, now = new, mark(new)
        if now == was:
            break
        was = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
