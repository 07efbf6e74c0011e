"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

Texts are cut into pre-tokens by the vocabulary's pattern. The distinct
pre-tokens of a batch that the task hasn't met yet are held together in one
flat array of symbols with a row number each (a ragged array). In every round
each row applies its own lowest-ranked pair, all rows at once; a row leaves
when no pair of it is in the table. What is left of a row is its token count.
Counts are kept in a memo of bounded size, which only saves work.

Defined cases: a null text counts as empty (0 bytes, 0 tokens). Special token
strings inside a text count as one token each, as the tokenizer's library does
by default. Whole texts are counted; nothing is added, cut or padded.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm import text as T
from martcraft.llm.tables import ship
from martcraft.llm.vocab import Memo, Splitter, Vocabulary, byte_symbols, read_vocabulary

# Fixed value: the split pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?{O}+|{S}+(?!{T})|{S}+"
MEMO = 250_000


class Counter:
    """Counts tokens of pre-tokens, many at a time."""

    def __init__(self, vocabulary: Vocabulary):
        self.keys, self.ranks, self.made = vocabulary.merge_table()
        self.base = np.array([vocabulary.ids[c] for c in byte_symbols()], dtype=np.int64)
        # If two merges make one token, a row may apply only the leftmost pair at a time.
        self.all_places = len(np.unique(self.made)) == len(self.made)
        self.split = Splitter(PATTERN)
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in vocabulary.special) + ")") if vocabulary.special else None
        self.memo = Memo(MEMO)

    def _ranks(self, sym: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pair at each place (huge if none), and the place of its merge in the table."""
        key = (sym[:-1] << 32) | sym[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[at] == key) & (row[:-1] == row[1:])
        return np.where(known, self.ranks[at], np.iinfo(np.int64).max), at

    def merged(self, pieces: list[str]) -> np.ndarray:
        """The number of symbols left of each piece."""
        raw = [p.encode() for p in pieces]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        sym = self.base[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        row = np.repeat(np.arange(len(raw)), size)
        left = size.copy()
        none = np.iinfo(np.int64).max
        while len(sym) > 1:
            rank, at = self._ranks(sym, row)
            begin = np.flatnonzero(np.diff(row, prepend=-1))
            lowest = np.minimum.reduceat(np.append(rank, none), begin)
            per = np.repeat(lowest, np.diff(np.append(begin, len(row))))
            hit = (rank == per[:-1]) & (rank != none)
            if not hit.any():
                break
            place = np.flatnonzero(hit)
            if self.all_places:  # in a run of overlapping pairs every other one is merged, from the left
                run = np.flatnonzero(np.diff(place, prepend=-2) != 1)
                order = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
                place = place[order % 2 == 0]
            else:
                place = place[np.flatnonzero(np.diff(row[place], prepend=-1))]
            sym[place] = self.made[at[place]]
            left -= np.bincount(row[place], minlength=len(left))
            keep = np.ones(len(sym), dtype=bool)
            keep[place + 1] = False
            live = np.repeat(lowest != none, np.diff(np.append(begin, len(row))))
            keep &= live  # finished rows leave
            sym, row = sym[keep], row[keep]
        return left

    def __call__(self, texts: list[str]) -> list[int]:
        parts: list[list[str]] = []
        fixed: list[int] = []
        for t in texts:
            n, own = 0, []
            for i, s in enumerate(self.special.split(t) if self.special else [t]):
                if i % 2:
                    n += 1
                elif s:
                    own += self.split(s)
            parts.append(own)
            fixed.append(n)
        memo = self.memo
        fresh = memo.missing([p for own in parts for p in own])
        if fresh:
            memo.of.update(zip(fresh, self.merged(fresh).tolist(), strict=True))
        found = [n + sum(map(memo.of.__getitem__, own)) for n, own in zip(fixed, parts, strict=True)]
        memo.turn()
        return found


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """``doc_id long, n_bytes long, n_tokens long, over_limit boolean`` for every row; ``vocabulary`` is a JSON file's path."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            for s in T.slices(batch, "text"):
                texts = s.column("text").to_pylist()
                n = counter([t or "" for t in texts])
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), pa.array(np.diff(T.utf8(s.column("text"))[1])), pa.array(n, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    got = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)
