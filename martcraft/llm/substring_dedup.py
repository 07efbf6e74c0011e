"""Substring deduplication by relative Lempel-Ziv parsing.

Documents are packed into blocks; every block is both a reference block with an
index and a run of documents to parse. A document is factored greedily against
the index of all reference blocks at once:

1. *Index.* Every window of ``window`` words is assigned to its minimizer (the
   smallest hash among its word 5-grams). Consecutive windows with one
   minimizer form a phrase. Equal passages give equal phrases except at their
   two ends, whatever surrounds them. Each block sends each distinct phrase
   once, with the smallest doc_id holding it, to the index shard of the phrase's
   content, and each distinct minimizer, with the least and the greatest of its
   phrases, to the shard of the minimizer. So a passage or a word sequence that a
   third of all documents share costs one entry or two per block, in whatever
   company it stands.
2. *Look-up.* Content shards answer, per block: this phrase stands in a smaller
   document (a match, with that document as its source). Minimizer shards
   answer: there are other phrases with it, so a match may go on beyond the
   phrase's border.
3. *Boundaries.* Only for phrases of the second kind the single windows are
   looked up, in the same way, by a 128-bit hash.
4. *Factors.* Left to right, each matched phrase with the words of its last window
   is a factor, and so is each window matched alone at a border. A factor is at
   least ``window`` words long, so its words are duplicates, and stands whole in its
   source, the smallest document that has it. Factors that follow each other
   overlap; together they cover every word of a matched window.

A phrase is compared by 64 bits of its content beside 32 bits of its minimizer,
a window by 128 bits of word hashes. Work and shuffles grow with the input; no
step holds more than a block or an index shard.

Defined cases: a null or empty text has no words; texts with fewer words than
the window keep them all. Rows with the same doc_id don't remove each other's
words. A row whose doc_id is null is returned whole and is no reference.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm import text as T
from martcraft.llm.tables import blocks, saved, unpack

GRAM = 5
SHARD_BYTES = 6 << 20
ENTRY = "shard long, block long, a binary, b binary, doc binary"  # what a, b and doc are depends on the shard
ANSWER = "block long, kind int, a binary, b binary, doc binary"
MATCH, BORDER, WINDOW = 0, 1, 2
_NONE = np.iinfo(np.int64).max


class _Parse:
    """Phrases of one block."""

    def __init__(self, payload: bytes, window: int):
        rb = unpack(payload)
        self.window = window
        self.ids = rb.column("id").fill_null(_NONE).to_numpy(zero_copy_only=False)
        self.null_id = rb.column("id").is_null().to_numpy(zero_copy_only=False)
        self.texts = rb.column("text")
        self.words = w = T.words(*T.utf8(self.texts))
        self.h = w.hashes()
        k = window - GRAM + 1
        grams = T.ngrams(self.h, GRAM)
        n = len(self.h) - window + 1
        if n <= 0:
            self.begin = self.end = np.zeros(0, dtype=np.int64)
            self.key = self.content = np.zeros(0, dtype=T.U)
            self.doc = np.zeros(0, dtype=np.int64)
            return
        low = grams[:n].copy()
        for j in range(1, k):
            np.minimum(low, grams[j:j + n], out=low)
        place = np.zeros(n, dtype=np.int64)
        for j in range(k - 1, -1, -1):
            hit = grams[j:j + n] == low
            place[hit] = np.flatnonzero(hit) + j
        usable = (w.row[:n] == w.row[window - 1:]) & ~self.null_id[w.row[:n]]
        at = np.flatnonzero(usable)
        if len(at):
            new = np.ones(len(at), dtype=bool)
            new[1:] = (np.diff(at) != 1) | (place[at[1:]] != place[at[:-1]])
            last = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
            self.begin, self.end = at[new], at[last] + 1  # of windows
        else:
            self.begin = self.end = at
        self.key = low[self.begin] if len(at) else np.zeros(0, dtype=T.U)
        self.content = T.span_hashes(self.h, self.begin, self.end + window - 1)
        self.doc = self.ids[w.row[self.begin]]

    def firsts(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The item with the smallest document for each distinct (a, b), and that document for every item."""
        order = np.lexsort((doc, b, a))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
        lead = order[new]
        least = np.empty(len(order), dtype=np.int64)
        least[order] = doc[lead][np.cumsum(new) - 1]
        return lead, least

    def windows(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows of these phrases: their places, two hashes and documents."""
        sizes = self.end[phrases] - self.begin[phrases]
        at = np.repeat(self.begin[phrases] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
        a, b = np.zeros(len(at), dtype=T.U), np.zeros(len(at), dtype=T.U)
        for j in range(self.window):
            x = self.h[at + j]
            a = a * T.U(0xD6E8FEB86659FD93) + x
            b = (b ^ x) * T.U(0xA0761D6478BD642F)
        return at, T.mix(a), T.mix(b), np.repeat(self.doc[phrases], sizes)


def _entries(block: int, shards: int, a: np.ndarray, b: np.ndarray, doc: np.ndarray, first_shard: int = 0) -> pa.RecordBatch:
    """One row per shard with the entries that go there, by ``a``."""
    shard = (a % T.U(shards)).astype(np.int64) + first_shard
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.diff(shard[order])) + 1
    groups = np.split(order, cut) if len(order) else []
    return pa.RecordBatch.from_pydict({
        "shard": [int(shard[g[0]]) for g in groups], "block": [block] * len(groups),
        "a": [T.planes(a[g]) for g in groups], "b": [T.planes(b[g]) for g in groups], "doc": [T.planes(doc[g]) for g in groups],
    }, schema=pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("doc", pa.binary())]))


def _gather(t: pa.Table, b_type: type, doc_type: type = np.int64) -> tuple[np.ndarray, ...]:
    """Entries of a shard: their block's place in the table, a, b and document."""
    a = [T.unplanes(x, T.U) for x in t.column("a").to_pylist()]
    b = [T.unplanes(x, b_type) for x in t.column("b").to_pylist()]
    doc = [T.unplanes(x, doc_type) for x in t.column("doc").to_pylist()]
    return np.repeat(np.arange(len(a)), [len(x) for x in a]), np.concatenate(a), np.concatenate(b), np.concatenate(doc)


_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("doc", pa.binary())])


def _answers(t: pa.Table, src: np.ndarray, found: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    names = t.column("block").to_pylist()
    rows: dict[str, list] = {n: [] for n in _ANSWER.names}
    for kind, at, a, b, doc in found:
        order = np.argsort(src[at], kind="stable")
        at = at[order]
        for g in np.split(np.arange(len(at)), np.flatnonzero(np.diff(src[at])) + 1) if len(at) else []:
            i = at[g]
            rows["block"].append(names[src[i[0]]])
            rows["kind"].append(kind)
            rows["a"].append(T.planes(a[i]))
            rows["b"].append(T.planes(b[i]))
            rows["doc"].append(T.planes(doc[i]))
    return pa.table(rows, schema=_ANSWER)


def _least_documents(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every entry the smallest document of its (a, b)."""
    order = np.lexsort((doc, b, a))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    out = np.empty(len(order), dtype=np.int64)
    out[order] = doc[order][new][np.cumsum(new) - 1]
    return out


def _match_phrases(t: pa.Table) -> pa.Table:
    """Answers of a content shard (a: content, b: part of the minimizer)."""
    src, content, key, doc = _gather(t, np.uint32)
    source = _least_documents(content, key, doc)
    return _answers(t, src, [(MATCH, np.flatnonzero(doc > source), content, key, source)])


def _match_minimizers(t: pa.Table) -> pa.Table:
    """Answers of a minimizer shard (a: minimizer, b: content): those with several contents."""
    src, key, content, _ = _gather(t, T.U, np.uint8)
    order = np.lexsort((content, key))
    k, c = key[order], content[order]
    begin = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    last = np.append(begin[1:], len(k)) - 1
    several = np.empty(len(k), dtype=bool)
    several[order] = np.repeat(c[begin] != c[last], last - begin + 1)
    none = np.zeros(len(k), dtype=np.uint8)
    return _answers(t, src, [(BORDER, np.flatnonzero(several), key, none, none)])


def _match_windows(t: pa.Table) -> pa.Table:
    """Answers of a window shard (a, b: the window's hashes)."""
    src, a, b, doc = _gather(t, T.U)
    source = _least_documents(a, b, doc)
    return _answers(t, src, [(WINDOW, np.flatnonzero(doc > source), a, b, source)])


_TYPES = {MATCH: (np.uint32, np.int64), BORDER: (np.uint8, np.uint8), WINDOW: (T.U, np.int64)}  # of b and doc in answers


class _Look:
    """Answers of one kind as a sorted table of (a, b) with sources."""

    def __init__(self, t: pa.Table, kind: int):
        rows = [r for r in t.to_pylist() if r["kind"] == kind]
        b_type, doc_type = _TYPES[kind]
        a = np.concatenate([T.unplanes(r["a"], T.U) for r in rows] or [np.zeros(0, dtype=T.U)])
        b = np.concatenate([T.unplanes(r["b"], b_type) for r in rows] or [np.zeros(0, dtype=b_type)])
        doc = np.concatenate([T.unplanes(r["doc"], doc_type) for r in rows] or [np.zeros(0, dtype=doc_type)]).astype(np.int64)
        both = a ^ (b.astype(T.U) * T.U(0x9E3779B97F4A7C15))
        order = np.argsort(both, kind="stable")
        self.both, self.doc = both[order], doc[order]

    def __call__(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each (a, b) has an answer, and its source."""
        both = a ^ (b.astype(T.U) * T.U(0x9E3779B97F4A7C15))
        if len(self.both) == 0:
            return np.zeros(len(a), dtype=bool), np.full(len(a), _NONE)
        at = np.minimum(np.searchsorted(self.both, both), len(self.both) - 1)
        hit = self.both[at] == both
        return hit, np.where(hit, self.doc[at], _NONE)


def _borders(p: _Parse, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases matched inside the block or by an answer, their sources, and phrases whose windows are looked up."""
    _, least = p.firsts(p.key, p.content, p.doc)
    _, source = _Look(answers, MATCH)(p.content, p.key.astype(np.uint32))
    source = np.minimum(source, least)
    matched = source < p.doc
    check, _ = _Look(answers, BORDER)(p.key, np.zeros(len(p.key), dtype=np.uint8))
    return matched, source, np.flatnonzero(check & ~matched)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """Remove the words covered by a window of ``window`` words that also starts in a document with a smaller id.

    Returns ``doc_id long, n_words long, n_removed long, kept_text string`` and
    ``factors array<struct<start int, n_words int, source long>>`` (word positions;
    overlapping factors may share words). One row per input row.
    """
    if window < GRAM:
        raise ValueError(f"window must be at least {GRAM} words")
    table = saved(blocks(docs, id_col, text_col), "blocks")
    total = table.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    table = table.drop("n_bytes")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                p = _Parse(payload.as_buffer(), window)
                if len(p.key):
                    lead, _ = p.firsts(p.key, p.content, p.doc)  # in the order of minimizer and content
                    key, content = p.key[lead], p.content[lead]
                    yield _entries(block, shards, content, key.astype(np.uint32), p.doc[lead])
                    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                    last = np.append(begin[1:], len(key)) - 1
                    ends = np.concatenate([begin, last[last > begin]])
                    yield _entries(block, shards, key[ends], content[ends], np.zeros(len(ends), dtype=np.uint8), shards)

    def look_up(t: pa.Table) -> pa.Table:
        return _match_phrases(t) if t.column("shard")[0].as_py() < shards else _match_minimizers(t)

    def boundaries(mine: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for block, payload in zip(mine.column("block").to_pylist(), mine.column("payload"), strict=True):
            p = _Parse(payload.as_buffer(), window)
            if len(p.key):
                _, a, b, doc = p.windows(_borders(p, answers)[2])
                lead, _ = p.firsts(a, b, doc)
                out.append(_entries(block, shards, a[lead], b[lead], doc[lead]))
        schema = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("doc", pa.binary())])
        return pa.Table.from_batches(out, schema=schema)

    def factor(mine: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for payload in mine.column("payload"):
            out.append(_factored(_Parse(payload.as_buffer(), window), answers))
        return pa.Table.from_batches(out, schema=_RESULT)

    phrases = saved(table.mapInArrow(index, ENTRY).groupBy("shard").applyInArrow(look_up, ANSWER), "phrases")
    asked = table.groupBy("block").cogroup(phrases.groupBy("block")).applyInArrow(boundaries, ENTRY)
    found = saved(asked.groupBy("shard").applyInArrow(_match_windows, ANSWER), "windows")
    return table.groupBy("block").cogroup(phrases.unionByName(found).groupBy("block")).applyInArrow(
        factor, "doc_id long, n_words long, n_removed long, kept_text string, factors array<struct<start:int,n_words:int,source:bigint>>")


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()),
    ("factors", pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("source", pa.int64())]))),
])


def _factored(p: _Parse, answers: pa.Table) -> pa.RecordBatch:
    n = len(p.h)
    source = np.full(n, _NONE, dtype=np.int64)  # of the window that starts at a word
    unit = np.full(n, -1, dtype=np.int64)  # the phrase, or the single window, that was matched
    if len(p.key):
        matched, of_phrase, check = _borders(p, answers)
        full = np.flatnonzero(matched)
        sizes = p.end[full] - p.begin[full]
        at = np.repeat(p.begin[full] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
        source[at] = np.repeat(of_phrase[full], sizes)
        unit[at] = np.repeat(full, sizes)
        at, a, b, doc = p.windows(check)
        if len(at):
            _, least = p.firsts(a, b, doc)
            _, got = _Look(answers, WINDOW)(a, b)
            got = np.minimum(got, least)
            source[at] = np.where(got < doc, got, _NONE)
            unit[at] = len(p.key) + np.arange(len(at))
    hit = np.flatnonzero(source != _NONE)
    w = p.words
    new = np.ones(len(hit), dtype=bool)
    new[1:] = (np.diff(hit) != 1) | (unit[hit[1:]] != unit[hit[:-1]])
    begin = hit[new]
    end = (hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)] if len(hit) else hit) + p.window
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, begin, 1)
    np.add.at(depth, end, -1)
    keep = np.cumsum(depth[:-1]) == 0
    first, per = w.first, w.per_row()
    kept_before = np.append(0, np.cumsum(keep))
    kept = kept_before[first[1:]] - kept_before[first[:-1]]
    rows_of = w.row[begin] if n else begin
    spans: list[list] = [[] for _ in per]
    for r, s, e, src in zip(rows_of.tolist(), begin.tolist(), end.tolist(), source[begin].tolist() if n else [], strict=True):
        spans[r].append({"start": s - int(first[r]), "n_words": e - s, "source": src})
    texts = []
    for r, (text, k, m) in enumerate(zip(p.texts, kept.tolist(), per.tolist(), strict=True)):
        if k == 0:
            texts.append("")
            continue
        own = text.as_py().encode().split()
        texts.append(b" ".join(own if k == m else compress(own, keep[first[r]:first[r + 1]])).decode())
    ids = pa.array(p.ids, mask=p.null_id)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(per, pa.int64()), pa.array(per - kept, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, _RESULT.field("factors").type)],
        schema=_RESULT)
