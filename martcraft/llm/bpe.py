"""BPE encoding and decoding of a vocabulary with word ends.

A word's symbols form a doubly linked list. A priority queue holds the known
pairs by (rank, place); the best one is taken, skipped if stale (its symbols
have changed since), else merged in the list, and the pairs with its new
neighbours are queued. Decoding joins the vocabulary's strings by a space, as
the tokenizer's library does for a file without a decoder.

Text is prepared as the file says: special strings are cut out of the raw text,
the rest is put into NFC, white space runs become one space, letters become
lower case character by character, and the pattern's matches are the words.
Words of a task are kept in a memo of bounded size, which only saves work.

Defined cases: a null text is encoded as the empty text (no ids, decoded ""). A
text's ids don't depend on other rows. Words of any length are encoded whole.
"""
from __future__ import annotations

import sys
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm import text as T
from martcraft.llm.tables import ship
from martcraft.llm.vocab import Memo, Splitter, Vocabulary, byte_symbols, read_vocabulary

# Fixed value: the word pattern of the vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|{L}+|{N}|{O}+"
MEMO = 200_000


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        ids = vocabulary.ids
        self.tokens = vocabulary.tokens
        self.merges = {(ids[a] << 32) | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(vocabulary.merges)}
        chars = byte_symbols()
        self.inner = [ids[c] for c in chars]
        self.last = [ids[c + vocabulary.suffix] for c in chars]
        self.ids = ids
        self.words = Splitter(PATTERN)
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in vocabulary.special) + ")") if vocabulary.special else None
        self.memo = Memo(MEMO)

    def merge(self, raw: bytes) -> list[int]:
        """The ids of one word."""
        n = len(raw)
        sym = [self.inner[b] for b in raw[:-1]]
        sym.append(self.last[raw[-1]])
        if n == 1:
            return sym
        merges = self.merges
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            found = merges.get((sym[i] << 32) | sym[i + 1])
            if found:
                queue.append((found[0], i, sym[i], sym[i + 1], found[1]))
        heapify(queue)
        while queue:
            _, i, a, b, made = heappop(queue)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # stale
            sym[i] = made
            sym[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((made << 32) | sym[k])
                if found:
                    heappush(queue, (found[0], i, made, sym[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((sym[h] << 32) | made)
                if found:
                    heappush(queue, (found[0], h, sym[h], made, found[1]))
        return [s for s in sym if s >= 0]

    def _prepared(self, s: str) -> str:
        # White space runs need not become one space: the pattern's matches hold none.
        s = unicodedata.normalize("NFC", s)
        return s.lower() if "Σ" not in s else "".join(c.lower() for c in s)

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids as unsigned 32-bit integers of this machine's byte order, and the decoded text."""
        memo, out = self.memo, []
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                out.append(part)
                memo.of[part] = array("I", [self.ids[part]]).tobytes(), part
            else:
                got = self.words(self._prepared(part))
                for w in memo.missing(got):
                    ids = self.merge(w.encode())
                    memo.of[w] = array("I", ids).tobytes(), self.decode(ids)
                out += got
        found = list(map(memo.of.__getitem__, out))
        memo.turn()
        return b"".join([b for b, _ in found]), " ".join([d for _, d in found])

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, n_tokens long, ids binary, decoded string`` for every row.

    ``ids`` holds little-endian unsigned 32-bit integers; ``vocabulary`` is a JSON file's path.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            for s in T.slices(batch, "text"):
                got = [codec.encode(t or "") for t in s.column("text").to_pylist()]
                if sys.byteorder == "big":
                    got = [(b"".join(b[i:i + 4][::-1] for i in range(0, len(b), 4)), d) for b, d in got]
                yield pa.RecordBatch.from_arrays([
                    s.column("doc_id"), pa.array([len(b) // 4 for b, _ in got], pa.int64()),
                    pa.array([b for b, _ in got], pa.binary()), pa.array([d for _, d in got], pa.string()),
                ], names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        encode, "doc_id long, n_tokens long, ids binary, decoded string")
