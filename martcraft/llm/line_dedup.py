"""Line deduplication by pairwise alignment.

1. Every document becomes the sequence of its lines' hashes (lines with a word,
   white space at both ends ignored).
2. Every line files two runs of consecutive lines, of any length: the shortest
   one from it onwards and the shortest one up to it that reach ``min_words``
   words. Each block of ``min_words`` words is covered by runs inside it. A run's
   smallest document stands for all its holders: each later holder is paired with
   that one, so a run costs one pair per document however many share it.
3. Each pair is aligned by patience diff on the hashes: common ends first, then
   the lines that stand once on both sides, in their longest increasing
   sequence, then the gaps between them in the same way. Of several longest
   sequences the one is taken whose last line stands earliest in the earlier
   document, and so on backwards. A gap where no line stands once on both sides
   is aligned by an ordinary longest common subsequence.
4. Runs of aligned lines, consecutive on both sides, are common blocks. Blocks of
   at least ``min_words`` words are deleted from the later document, all copies of
   them, with the blank lines inside them. What is left is aligned again with the
   same document, for blocks that cross the first ones, until no block comes
   (``ROUNDS`` times at most). An exact check follows for the lines then left: the
   filed runs that hold one and stand whole in the earlier document go too. What
   several partners delete is united: all lines in a run of ``min_words`` words that
   stands whole in any earlier document.

Only hashes travel for pairing and alignment (16 bytes a line); texts are joined
once, at the end, with their deletions. Tasks take a batch in parts of a few MB, so
their memory follows the longest single document.

Defined cases: lines end at \\n. A null text stays null and has no lines. Rows
without a doc_id are returned whole and pair with nothing; rows with one doc_id
don't pair with each other. Deletions are judged on the input, so a line that
its first holder itself loses counts there still.
"""
from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from martcraft.llm import text as T
from martcraft.llm.tables import fresh, saved, ship

KEY = 16
ROUNDS = 4


def line_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Per row the hashes of its lines with words (16 bytes each), and over all rows those lines' row, number and words."""
    w = T.words(data, offsets)
    n = len(w)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return [b""] * (len(offsets) - 1), z, z, z
    newline = np.append(0, np.cumsum(data == 10))
    # The number of a word's line inside its row; words of one line follow each other.
    number = newline[w.start] - newline[offsets[:-1]][w.row]
    new = np.ones(n, dtype=bool)
    new[1:] = (w.row[1:] != w.row[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], n)
    a = T.span_hashes(data, w.start[first], w.end[last - 1])
    b = T.span_hashes(w.hashes(), first, last)
    keys = np.stack([a, b], axis=1)
    row = w.row[first]
    cut = np.searchsorted(row, np.arange(len(offsets)))
    return [keys[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], row, number[first], last - first


def _steps(a: list, b: list) -> Iterator[int]:
    """After each line of ``a`` the places of ``b`` as bits, 0 where the common subsequence gets longer by that place."""
    mask: dict[bytes, int] = {}
    for j, x in enumerate(b):
        mask[x] = mask.get(x, 0) | 1 << j
    v = full = (1 << len(b)) - 1
    for x in a:
        u = v & mask.get(x, 0)
        v = (v + u | v - u) & full
        yield v


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    for v in _steps(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8), count=len(b), bitorder="little")
    return np.append(0, np.cumsum(1 - bits.astype(np.int64)))


def longest_common(a: list, b: list, bits: int = 1 << 28) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, by bit vectors; halved (Hirschberg) where they would take more than ``bits``."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, i2, j, j2 = work.pop()
        if i == i2 or j == j2:
            continue
        if (i2 - i) * (j2 - j) > bits and i2 - i > 1:
            half = (i + i2) // 2
            k = j + int(np.argmax(_lengths(a[i:half], b[j:j2]) + _lengths(a[half:i2][::-1], b[j:j2][::-1])[::-1]))
            work += [(i, half, j, k), (half, i2, k, j2)]
            continue
        rows = list(_steps(a[i:i2], b[j:j2]))
        x, y = len(rows), j2 - j
        while x and y:
            if rows[x - 1] >> y - 1 & 1:
                y -= 1
                continue
            x -= 1
            if not x or rows[x - 1] >> y - 1 & 1:
                y -= 1
                out.append((i + x, j + y))
    return sorted(out)


def patience(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Places of aligned lines of ``a`` and ``b``, in order."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, i2, j, j2 = work.pop()
        while i < i2 and j < j2 and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            out.append((i2, j2))
        if i == i2 or j == j2:
            continue
        na, nb = Counter(a[i:i2]), Counter(b[j:j2])
        place = {b[y]: y for y in range(j, j2) if nb[b[y]] == 1}
        both = [(x, place[a[x]]) for x in range(i, i2) if na[a[x]] == 1 and a[x] in place]
        ends: list[int] = []
        nodes: list[tuple] = []
        for x, y in both:
            k = bisect_left(ends, y)
            node = (x, y, nodes[k - 1] if k else None)
            if k == len(ends):
                ends.append(y)
                nodes.append(node)
            else:
                ends[k] = y
                nodes[k] = node
        chain = []
        node = nodes[-1] if nodes else None
        while node:
            chain.append(node[:2])
            node = node[2]
        if not chain:
            out += [(i + x, j + y) for x, y in longest_common(a[i:i2], b[j:j2])]
            continue
        chain.reverse()
        x, y = i, j
        for p, q in [*chain, (i2, j2)]:
            work.append((x, p, y, q))
            x, y = p + 1, q + 1
        out += chain
    return sorted(out)


def common_blocks(a: list[bytes], b: list[bytes], n_words: list[int], min_words: int) -> list[int]:
    """Places in ``a`` of the lines in common blocks of at least ``min_words`` words."""
    out: list[int] = []
    run: list[int] = []
    at = (-2, -2)
    for i, j in [*patience(a, b), (-9, -9)]:
        if (i, j) != (at[0] + 1, at[1] + 1):
            if sum(n_words[x] for x in run) >= min_words:
                out += run
            run = []
        run.append(i)
        at = (i, j)
    return out


def shortest_runs(sizes: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the shortest runs of at least ``min_words`` words that begin or end at each line, inside the rows that ``offsets`` cut."""
    n = len(sizes)
    total = np.append(0, np.cumsum(sizes, dtype=np.int64))
    at, rows = np.arange(n), np.diff(offsets)
    first, end = np.repeat(offsets[:-1], rows), np.repeat(offsets[1:], rows)
    to = np.searchsorted(total, total[:-1] + min_words)
    since = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    on, back = to <= end, since >= first
    runs = np.unique(np.stack([np.append(at[on], since[back]), np.append(to[on], at[back] + 1)], axis=1), axis=0)
    return runs[:, 0], runs[:, 1]


def aligned_lines(a: bytes, b: bytes, sizes: np.ndarray, min_words: int) -> set[int]:
    """Places in ``a`` of the lines that alignments with ``b`` find in common blocks, one after the other."""
    left, other, n_words = _split(a), _split(b), sizes.tolist()
    gone: set[int] = set()
    for _ in range(ROUNDS):
        found = common_blocks(left, other, n_words, min_words)
        if not found:
            break
        cut = [k for k in range(len(found)) if not k or found[k] != found[k - 1] + 1] + [len(found)]
        for block in {a[found[i] * KEY:(found[j - 1] + 1) * KEY] for i, j in zip(cut, cut[1:], strict=False)}:
            at = a.find(block)
            while at >= 0:  # every copy
                if at % KEY == 0:
                    gone.update(range(at // KEY, (at + len(block)) // KEY))
                    at = a.find(block, at + len(block))
                else:
                    at = a.find(block, at + 1)
        for i in gone:
            left[i] = b"%d" % i  # equals nothing
    return gone


def held_runs(a: bytes, b: bytes, sizes: np.ndarray, min_words: int, gone: set[int]) -> set[int]:
    """Places in ``a`` of the lines in shortest runs that hold a line not in ``gone`` and stand whole in ``b``."""
    out: set[int] = set()
    lost = np.append(0, np.cumsum(np.isin(np.arange(len(sizes)), list(gone))))
    start, end = shortest_runs(sizes, np.array([0, len(sizes)]), min_words)
    todo = lost[end] - lost[start] < end - start
    start, size = start[todo], (end - start)[todo]
    for m in np.unique(size).tolist():  # the parts of one length at a time
        n = m * KEY
        held = {b[k:k + n] for k in range(0, len(b) - n + 1, KEY)}
        for i in start[size == m].tolist():
            if a[i * KEY:i * KEY + n] in held:
                out.update(range(i, i + m))
    return out


def _signature(keys: bytes) -> int:
    """Tells apart rows that share an id."""
    return int.from_bytes(hashlib.blake2b(keys, digest_size=8).digest(), "little", signed=True)


def _split(b: bytes) -> list[bytes]:
    return [b[i:i + KEY] for i in range(0, len(b), KEY)]


def portions(batch: pa.RecordBatch, columns: list[str], limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` with about ``limit`` bytes of its binary ``columns`` each (a longer row stands alone)."""
    sizes = sum(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    off, at = np.append(0, np.cumsum(sizes)), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def filed_runs(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """The shortest runs of rows ``id, keys, sizes``: two hashes of each and the row's id."""
    for batch in batches:
        for s in portions(batch, ["keys"]):
            of = s.column("keys").to_pylist()
            keys = np.frombuffer(b"".join(of), dtype=np.uint64).reshape(-1, 2)
            sizes = np.frombuffer(b"".join(s.column("sizes").to_pylist()), dtype=np.int32)
            offsets = np.append(0, np.cumsum([len(k) // KEY for k in of]))
            i, j = shortest_runs(sizes, offsets, min_words)
            ids = s.column("id").to_numpy()[np.searchsorted(offsets, i, side="right") - 1]
            a, b = (T.span_hashes(np.ascontiguousarray(keys[:, c]), i, j).view(np.int64) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(ids)], names=["a", "b", "id"])


def lost_lines(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """The places of the lines that rows ``id, sig, keys, sizes`` lose to the document whose lines are in ``other``."""
    schema = pa.schema([("id", pa.int64()), ("sig", pa.int64()), ("gone", pa.list_(pa.int32()))])
    for batch in batches:
        for s in portions(batch, ["keys", "other"]):
            out: dict[str, list] = {"id": [], "sig": [], "gone": []}
            for i, sig, keys, sizes, other in zip(*(s.column(c).to_pylist() for c in ("id", "sig", "keys", "sizes", "other")), strict=True):
                n_words = np.frombuffer(sizes, dtype=np.int32)
                lines = aligned_lines(keys, other, n_words, min_words)
                gone = sorted(lines | held_runs(keys, other, n_words, min_words, lines))
                if gone:
                    out["id"].append(i)
                    out["sig"].append(sig)
                    out["gone"].append(gone)
            yield pa.RecordBatch.from_pydict(out, schema=schema)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10) -> DataFrame:
    """The rows of ``docs`` with ``text_col`` replaced by what is kept, and the columns
    ``n_lines long, n_removed_lines long, n_removed_words long`` (lines with a word).

    A new column whose name ``docs`` has already is called by that name with ``_``
    behind it.
    """
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, "text"):
                keys, row, _, n = line_keys(*T.utf8(s.column("text")))
                cut = np.searchsorted(row, np.arange(s.num_rows + 1))
                sizes = [n[i:j].astype(np.int32).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
                out = pa.RecordBatch.from_arrays([s.column("id"), pa.array(map(_signature, keys), pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.binary())],
                                                 names=["id", "sig", "keys", "sizes"])
                yield out.filter(pa.array([len(k) > 0 for k in keys]))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return filed_runs(batches, min_words)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return lost_lines(batches, min_words)

    seqs = saved(src.mapInArrow(sequences, "id long, sig long, keys binary, sizes binary").dropDuplicates(["id", "sig"]), "lines")
    filed = seqs.mapInArrow(runs, "a long, b long, id long")
    first = filed.groupBy("a", "b").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    # Written, so that both sides of the join are plain shuffles and a very common run's part can be split.
    first = saved(first, "first")
    pairs = filed.join(first, ["a", "b"]).where("id > first").select("id", "first").distinct()
    pairs = saved(pairs, "pairs")
    earlier = seqs.select(F.col("id").alias("first"), F.col("keys").alias("other"))
    aligned = pairs.join(earlier, "first").join(seqs, "id")
    gone = aligned.select("id", "sig", "keys", "sizes", "other").mapInArrow(align, "id long, sig long, gone array<int>")
    gone = gone.groupBy("id", "sig").agg(F.array_distinct(F.flatten(F.collect_set("gone"))).alias("gone"))
    gone = gone.groupBy("id").agg(F.collect_list(F.struct("sig", "gone")).alias("gone"))
    return _without(docs, gone, id_col, text_col)


def _without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    names = docs.columns
    new = [fresh(c, names) for c in ("n_lines", "n_removed_lines", "n_removed_words")]
    # Several rows may share an id; each row's lines are hashed again to find its own entry.
    sigs, places = fresh("sigs", [*names, *new]), fresh("places", [*names, *new])
    joined = docs.join(gone, docs[id_col].cast("long") == gone["id"], "left")
    own = [docs[c].cast("string").alias(c) if c == text_col else docs[c] for c in names]
    joined = joined.select(*own, F.transform(gone["gone"], lambda g: g["sig"]).alias(sigs), F.transform(gone["gone"], lambda g: g["gone"]).alias(places))
    schema = StructType([StructField(f.name, StringType() if f.name == text_col else f.dataType) for f in docs.schema.fields]
                        + [StructField(c, LongType()) for c in new])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, text_col):
                texts = s.column(text_col).to_pylist()
                keys, row, number, words = line_keys(*T.utf8(s.column(text_col)))
                at = np.searchsorted(row, np.arange(s.num_rows + 1))
                n_gone, n_words = [0] * len(texts), [0] * len(texts)
                for r, (have, lost) in enumerate(zip(s.column(sigs).to_pylist(), s.column(places).to_pylist(), strict=True)):
                    mine = _signature(keys[r]) if have else None
                    if have and mine in have:
                        gone_lines = sorted(lost[have.index(mine)])
                        numbers, sizes = number[at[r]:at[r + 1]].tolist(), words[at[r]:at[r + 1]].tolist()
                        n_gone[r], n_words[r] = len(gone_lines), sum(sizes[x] for x in gone_lines)
                        drop = {numbers[x] for x in gone_lines}
                        for x, y in zip(gone_lines, gone_lines[1:], strict=False):
                            if y == x + 1:  # blank lines between two lost ones
                                drop.update(range(numbers[x], numbers[y]))
                        texts[r] = "\n".join(line for i, line in enumerate(texts[r].split("\n")) if i not in drop)
                cols = [pa.array(texts, pa.string()) if c == text_col else s.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.diff(at)), pa.array(n_gone, pa.int64()), pa.array(n_words, pa.int64())], names=[*names, *new])

    return joined.mapInArrow(cut, schema)
