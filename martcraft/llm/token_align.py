"""Cross-tokenizer alignment: whitespace-token anchors and memoised windows.

Each whole text is encoded by two vocabularies: a space and the text by the
byte-level one (A), the text by the piece one (B), which adds that space itself.
Where tokens of A and B end at the same byte and the next token of each begins
with a space, there is an anchor. Anchors cut the documents of a block into
windows: the ids of A and of B between two anchors. The block's memo holds every
different pair of id tuples once (found by hash and compared token by token), and
only the memo is aligned: inside a window, every further byte at which tokens of
both end cuts it into groups; the links of a group are all its pairs of an A and a B
token. Documents are sequences of the memo's numbers.

Documents are packed into blocks of about ``BLOCK_BYTES`` of text. A block lists its
different pairs of ids with the number of its documents that hold them. These counts
are summed over the corpus (a pair is one row per block, reduced again by the partial
aggregate before the shuffle), an A id's highest count is taken from the pairs'
counts, and both return to the blocks by a join on the pair; a very common pair has
one row per block there, and its part can be split. Each block then scores its own
documents.

Defined cases: a text that is null or empty, or whose joined A or B bytes differ
from a space and the text, has no tokens: zeros and empty groups. Strings of special
tokens inside texts are plain text. Every row is a document of its own for the
counts, also rows with a null or a repeated id. An empty table gives an empty one;
other columns of ``docs`` are not looked at. A task's memory follows its longest text.
"""
from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property, lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm import text as T
from martcraft.llm.tables import saved, ship
from martcraft.llm.token_count import PATTERN
from martcraft.llm.vocab import byte_symbols

BLOCK_BYTES = 2 << 20
ENCODE_BYTES = 1 << 18
WIDE_GROUP = 1 << 12
_BLOCK = pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))])
_OUT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups", pa.string())])


class Aligner:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, json_text: str, model: bytes):
        import sentencepiece

        self.json_text = json_text
        raw = json.loads(json_text)
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        names = {i: t for t, i in raw["model"]["vocab"].items()} | {t["id"]: t["content"] for t in raw["added_tokens"]}
        self.quick = _quick(raw, byte_of)
        self.bytes_a = [bytes(byte_of[c] for c in names[i]) if i in names and all(c in byte_of for c in names[i]) else b"" for i in range(max(names) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.len_a, self.len_b = (np.array([len(t) for t in ts], dtype=np.int64) for ts in (self.bytes_a, self.bytes_b))
        self.hash_a, self.hash_b = (T.mix(np.arange(len(ts)).astype(T.U)) for ts in (self.bytes_a, self.bytes_b))
        self.space_a, self.space_b = (np.array([t[:1] == b" " for t in ts]) for ts in (self.bytes_a, self.bytes_b))

    @cached_property
    def a(self):
        """The JSON file's own library, loaded for the first text that needs it."""
        from tokenizers import Tokenizer

        a = Tokenizer.from_str(self.json_text)
        a.encode_special_tokens = True
        a.no_padding()
        a.no_truncation()
        return a

    def encode_a(self, text: str) -> list[int]:
        """By the ranks where that library reads the text's characters alike, else by the JSON file's own one."""
        if self.quick and not _unsettled().search(text):
            return self.quick.encode_ordinary(" " + text)  # loses no byte
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        return ids if b"".join(map(self.bytes_a.__getitem__, ids)) == b" " + text.encode() else []

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """The ids of every text, none where the bytes of one side aren't the text's."""
        some = [t for t in texts if t]
        found = iter(zip(map(self.encode_a, some), self.b.encode(some, num_threads=1), strict=True))
        out = []
        for t in texts:
            a: list[int] = []
            b: list[int] = []
            if t:
                own, ids = next(found)
                if own and b"".join(map(self.bytes_b.__getitem__, ids)) == b" " + t.encode():
                    a, b = own, ids
            out.append((a, b))
        return out

    def anchors(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first tokens of the windows in ``a`` and in ``b``: space-marked ones that begin at the same byte."""
        marked = [np.flatnonzero(space[x]) for space, x in ((self.space_a, a), (self.space_b, b))]
        at = [(np.cumsum(size[x]) - size[x])[m] for size, x, m in ((self.len_a, a, marked[0]), (self.len_b, b, marked[1]))]
        _, i, j = np.intersect1d(*at, assume_unique=True, return_indices=True)
        return marked[0][i], marked[1][j]

    def memo(self, a: np.ndarray, b: np.ndarray) -> tuple[Windows, np.ndarray, np.ndarray]:
        """The different windows, aligned; the number of each window of the block, and its first token in ``a``."""
        begin_a, begin_b = self.anchors(a, b)
        end_a, end_b = np.append(begin_a[1:], len(a))[:len(begin_a)], np.append(begin_b[1:], len(b))[:len(begin_b)]
        key = T.mix(T.span_hashes(self.hash_a[a], begin_a, end_a) + T.span_hashes(self.hash_b[b], begin_b, end_b) * T.U(0xD6E8FEB86659FD93))
        _, first, code = np.unique(key, return_index=True, return_inverse=True)
        first, code = first.astype(np.int64), code.astype(np.int64)
        like = first[code]
        same = (end_a - begin_a == (end_a - begin_a)[like]) & (end_b - begin_b == (end_b - begin_b)[like])
        for x, i, j in ((a, begin_a, end_a), (b, begin_b, end_b)):
            size = np.where(same, j - i, 0)
            differ = x[_ragged(i, size)] != x[_ragged(i[like], size)]
            same[np.repeat(np.arange(len(i)), size)[differ]] = False
        first = np.append(first, np.flatnonzero(~same))  # windows whose hash is another's stand alone
        code[~same] = np.arange(len(first) - (~same).sum(), len(first))
        often = np.argsort(-np.bincount(code, minlength=len(first)), kind="stable")  # small numbers pack better
        rank = np.empty(len(often), dtype=np.int64)
        rank[often] = np.arange(len(often))
        first = first[often]
        n_a, n_b = (end_a - begin_a)[first], (end_b - begin_b)[first]
        own_a, own_b = a[_ragged(begin_a[first], n_a)], b[_ragged(begin_b[first], n_b)]
        _, cut_a, cut_b = np.intersect1d(np.cumsum(self.len_a[own_a]), np.cumsum(self.len_b[own_b]), assume_unique=True, return_indices=True)
        groups = np.diff(np.searchsorted(cut_a + 1, np.cumsum(n_a), side="right"), prepend=0)
        return Windows(own_a, own_b, np.diff(cut_a + 1, prepend=0), np.diff(cut_b + 1, prepend=0), groups), rank[code], begin_a

    def block(self, ids: list[int | None], coded: list[tuple[np.ndarray, np.ndarray]]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The block's documents packed, its different pairs, and how many of its documents hold each."""
        n_a, n_b = (np.array([len(c[k]) for c in coded], dtype=np.int64) for k in (0, 1))
        a, b = (np.concatenate([c[k] for c in coded]) for k in (0, 1))
        windows, code, begin = self.memo(a, b)
        n_windows = np.diff(np.searchsorted(begin, np.append(0, np.cumsum(n_a))))
        pair, _, size = windows.links()
        pairs, place = np.unique(pair, return_inverse=True)
        # Documents that hold a pair: different (document, window), then different (document, pair).
        wide = max(1, len(windows.groups))
        seen = _different(np.repeat(np.arange(len(coded)), n_windows) * wide + code)
        each = size[seen % wide]
        doc = np.repeat(seen // wide, each)
        held = _different(doc * max(1, len(pairs)) + place[_ragged((np.cumsum(size) - size)[seen % wide], each)])
        counts = np.bincount(held % max(1, len(pairs)), minlength=len(pairs))
        packed = _packed(ids, {"n_a": n_a, "n_b": n_b, "n_windows": n_windows, "code": code, "a": windows.a, "b": windows.b,
                               "size_a": windows.size_a, "size_b": windows.size_b, "groups": windows.groups})
        return packed, pairs, counts[:len(pairs)]


def _different(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of spans, one span after the other."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(begin - (end - size), size)


@dataclass
class Windows:
    """Aligned windows: their ids one after the other, the tokens of each group, and the groups of each window."""

    a: np.ndarray
    b: np.ndarray
    size_a: np.ndarray
    size_b: np.ndarray
    groups: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (A id * 2^32 + B id) and how often each is linked, window after window, and the pairs of each window."""
        begin_a, begin_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        wide = self.size_a * self.size_b > WIDE_GROUP  # their ids are counted first
        pairs = np.where(wide, 0, self.size_a * self.size_b)
        nth = _ragged(np.zeros(len(pairs), dtype=np.int64), pairs)
        of = np.repeat(np.arange(len(pairs)), pairs)
        pair = self.a[begin_a[of] + nth // self.size_b[of]].astype(np.int64) << 32 | self.b[begin_b[of] + nth % self.size_b[of]]
        times = np.ones(len(pair), dtype=np.int64)
        if wide.any():
            at, parts, counted = np.append(0, np.cumsum(pairs)), [], []
            since = 0
            for g in np.flatnonzero(wide).tolist():
                x, n = np.unique(self.a[begin_a[g]:begin_a[g] + self.size_a[g]], return_counts=True)
                y, m = np.unique(self.b[begin_b[g]:begin_b[g] + self.size_b[g]], return_counts=True)
                parts += [pair[since:at[g]], (x.astype(np.int64)[:, None] << 32 | y).ravel()]
                counted += [times[since:at[g]], (n[:, None] * m).ravel()]
                since, pairs[g] = at[g], len(x) * len(y)
            pair, times = np.concatenate([*parts, pair[since:]]), np.concatenate([*counted, times[since:]])
        total = np.append(0, np.cumsum(pairs))
        end = np.cumsum(self.groups)
        return pair, times, total[end] - total[end - self.groups]

    def texts(self) -> list[str]:
        """Each window's groups as ``a1,a2|b1;a3|b2,b3``."""
        if not len(self.groups):
            return []
        each = np.stack([self.size_a, self.size_b], axis=1).ravel()  # A and B parts by turns
        end = np.cumsum(each)
        out = np.empty(end[-1], dtype=np.int64)
        out[_ragged((end - each)[::2], self.size_a)], out[_ragged((end - each)[1::2], self.size_b)] = self.a, self.b
        mark = np.zeros(end[-1], dtype=np.int64)  # what follows: , | ; or the window's end
        mark[end[::2] - 1], mark[end[1::2] - 1] = 1, 2
        mark[end[1::2][np.cumsum(self.groups) - 1] - 1] = 3
        top = max(16, int(out.max()).bit_length())
        return "".join(map(_numbers(top).__getitem__, (mark << top | out).tolist())).split("\n")[:-1]


@lru_cache(maxsize=1)
def _numbers(bits: int) -> list[str]:
    """The numbers below 2 ** bits with what can follow them."""
    return [str(i) + m for m in ",|;\n" for i in range(1 << bits)]


def _packed(ids: list[int | None], arrays: dict[str, np.ndarray]) -> bytes:
    columns = {k: pa.array([T.planes(v.astype(np.int32))]) for k, v in arrays.items()} | {"ids": pa.array([ids], pa.list_(pa.int64()))}
    rb = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rb.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(rb)
    return sink.getvalue().to_pybytes()


def _unpacked(docs: bytes) -> tuple[pa.Array, dict[str, np.ndarray]]:
    with pa.ipc.open_stream(docs) as r:
        t = r.read_all()
    return t.column("ids").combine_chunks().flatten(), {k: T.unplanes(t.column(k)[0].as_py(), np.int32).astype(np.int64) for k in t.column_names if k != "ids"}


def score(docs: bytes, pairs: np.ndarray, df: np.ndarray, best: np.ndarray) -> pa.Table:
    """The result rows of a block; ``df`` and ``best`` belong to its ``pairs``."""
    ids, of = _unpacked(docs)
    windows = Windows(*(of[k] for k in ("a", "b", "size_a", "size_b", "groups")))
    pair, times, size = windows.links()
    order = np.argsort(pairs)
    place = order[np.searchsorted(pairs, pair, sorter=order)] if len(pairs) else np.zeros(0, dtype=np.int64)
    bounds = np.append(0, np.cumsum(of["n_windows"]))
    end = np.cumsum(size)

    def over_windows(window: np.ndarray) -> pa.Array:
        return pa.array(np.diff(np.append(0, np.cumsum(window[of["code"]]))[bounds]))

    def over_links(link: np.ndarray) -> pa.Array:
        total = np.append(0, np.cumsum(link))
        return over_windows(total[end] - total[end - size])

    ordered = list(map(windows.texts().__getitem__, of["code"].tolist()))
    groups = [";".join(ordered[i:j]) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return pa.table([ids, pa.array(of["n_a"]), pa.array(of["n_b"]), over_windows(windows.groups), over_links(times),
                     over_links(times * best[place]), over_links(times * df[place]), pa.array(groups, pa.string())], schema=_OUT)


@cache
def _unsettled() -> re.Pattern:
    """Characters that versions of Unicode, or libraries, class differently (as letter, number, white space or none of them)."""
    old = unicodedata.ucd_3_2_0.category
    odd = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000 and old(chr(c)) != unicodedata.category(chr(c))]
    odd += [0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0x180E, 0x200B, *range(0x10000, 0x110000)]
    runs: list[list[int]] = []
    for c in sorted(set(odd)):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]")


def _quick(raw: dict, byte_of: dict[str, int]):
    """The vocabulary as ranks, if its ids are its merges' order and it is split by the common pattern; else none.

    The library of ranks gives the same ids in a quarter of the time.
    """
    model, split = raw["model"], raw["pre_tokenizer"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"][x + y] for x, y in merges]
    plain = split["type"] == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"] and not raw["normalizer"]
    if not plain or any(x >= y for x, y in pairwise([255, *made])) or model.get("dropout") or model.get("ignore_merges"):
        return None
    import tiktoken

    special = {t["content"] for t in raw["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    letter = {"L": r"\p{L}", "N": r"\p{N}", "O": r"[^\s\p{L}\p{N}]", "S": r"\s", "T": r"\S"}
    return tiktoken.Encoding("a", pat_str=PATTERN.format(**letter), mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _aligner(json_text: str, model: bytes) -> Aligner:
    return Aligner(json_text, model)


def align_tokens(docs: DataFrame, vocabulary: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum`` (long) and ``groups string``.

    ``vocabulary`` and ``pieces`` are the paths of a byte-level JSON file (A) and of a piece model (B).
    An id pair's count is the number of documents that hold it linked; ``n_best`` counts the links
    whose count is the highest of their A id, ``count_sum`` adds the counts of all links. ``groups`` lists the groups
    as ``a1,a2|b1;a3|b2,b3``.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, encoding="utf-8") as f, open(pieces, "rb") as g:
        shared = spark.sparkContext.broadcast((f.read(), g.read()))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = _aligner(*shared.value)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        coded: list = []
        size = 0

        def out() -> pa.RecordBatch:
            nonlocal ids, coded, size, seq
            packed, pairs, counts = aligner.block(ids, coded)
            row = pa.RecordBatch.from_arrays([
                pa.array([(part << 32) | seq]), pa.array([packed], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs)),
                pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(counts.astype(np.int32)))], schema=_BLOCK)
            ids, coded, size, seq = [], [], 0, seq + 1
            return row

        for batch in batches:
            for s in T.slices(batch, "text", ENCODE_BYTES):
                n = int(T.utf8(s.column("text"))[1][-1])
                if ids and size + n > BLOCK_BYTES:
                    yield out()
                ids += s.column("id").to_pylist()
                coded += [(np.array(a, dtype=np.int32), np.array(b, dtype=np.int32)) for a, b in aligner.encode(s.column("text").to_pylist())]
                size += n
        if ids:
            yield out()

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = saved(src.mapInArrow(aligned, "block long, docs binary, pairs array<long>, counts array<int>"), "aligned")
    held = blocks.select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("block", "x.pairs", "x.counts")
    freq = held.groupBy("pairs").agg(F.sum("counts").alias("df")).withColumn("a", F.shiftright("pairs", 32))
    top = freq.groupBy("a").agg(F.max("df").alias("top"))
    # Written, so that both sides of the join back are plain shuffles and a very common pair's part can be split.
    scored = saved(freq.join(top, "a").select("pairs", "df", (F.col("df") == F.col("top")).alias("best")), "pairs")
    back = held.join(scored, "pairs").select(F.col("block").alias("of"), "pairs", "df", "best")

    def scores(block: pa.Table, found: pa.Table) -> pa.Table:
        done = [score(d, *(found.column(c).to_numpy() for c in ("pairs", "df", "best"))) for d in block.column("docs").to_pylist()]
        return pa.concat_tables(done) if done else _OUT.empty_table()

    return blocks.select("block", "docs").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(
        scores, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
