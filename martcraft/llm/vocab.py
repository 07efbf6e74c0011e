"""Vocabulary files of public tokenizers (JSON), read on the driver and broadcast to tasks."""
from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import regex

# Fixed value: the characters with the White_Space property, for use inside a character class.
WHITE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next code from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """Fixed size: as many entries as the file has."""

    ids: dict[str, int]
    merges: list[tuple[str, str]]
    special: list[str]
    suffix: str

    @property
    def tokens(self) -> list[str]:
        out = [""] * (max(self.ids.values()) + 1)
        for t, i in self.ids.items():
            out[i] = t
        return out

    def merge_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys left * 2^32 + right of the merges, with the rank and the merged id of each."""
        left = np.array([self.ids[a] for a, _ in self.merges], dtype=np.int64)
        right = np.array([self.ids[b] for _, b in self.merges], dtype=np.int64)
        made = np.array([self.ids[a + b] for a, b in self.merges], dtype=np.int64)
        key = (left << 32) | right
        order = np.argsort(key)
        return key[order], order.astype(np.int64), made[order]


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    model = raw["model"]
    ids = dict(model["vocab"])
    for t in raw["added_tokens"]:
        ids[t["content"]] = t["id"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return Vocabulary(ids, merges, [t["content"] for t in raw["added_tokens"]], model.get("end_of_word_suffix") or "")


@cache
def _late() -> str:
    """Letters and numbers that the pattern engine knows but the Unicode data of Python (and of the tokenizers) doesn't, as a class's inside."""
    known = regex.compile(r"[\p{L}\p{N}]")
    late = [c for c in range(128, 0x110000) if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
    runs: list[list[int]] = []
    for c in late:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


# Numbers below U+0250 that are neither digits nor letters.
_LATIN_NUMBERS = "²³¹¼½¾"


class Splitter:
    """Finds the matches of a pattern whose ``{L}``, ``{N}``, ``{S}``, ``{O}`` and ``{T}`` stand for a letter, a number, white space, anything else, and anything but white space.

    Texts of characters below U+0250 go to the standard engine, for which the
    classes are spelled out; others to the one that knows Unicode's properties.
    """

    def __init__(self, pattern: str):
        self.beyond = re.compile("[\u0250-\U0010ffff\x1c-\x1f]")  # the controls are white space for the standard engine only
        self.latin = re.compile(pattern.format(
            L=rf"[^\W\d_{_LATIN_NUMBERS}]", N=rf"[\d{_LATIN_NUMBERS}]", O=r"(?:[^\w\s]|_)", S=r"\s", T=r"\S"))
        late = _late()
        self.fast = regex.compile(pattern.format(L=r"[\p{L}]", N=r"[\p{N}]", O=rf"[^{WHITE}\p{{L}}\p{{N}}]", S=rf"[{WHITE}]", T=rf"[^{WHITE}]"))
        self.exact = self.fast
        self.late = None
        if late:
            self.late = regex.compile(f"[{late}]")
            self.exact = regex.compile("(?V1)" + pattern.format(
                L=rf"[\p{{L}}--[{late}]]", N=rf"[\p{{N}}--[{late}]]", O=rf"(?:[^{WHITE}\p{{L}}\p{{N}}]|[{late}])", S=rf"[{WHITE}]", T=rf"[^{WHITE}]"))

    def __call__(self, s: str) -> list[str]:
        if not self.beyond.search(s):
            return self.latin.findall(s)
        if self.late is None or not self.late.search(s):
            return self.fast.findall(s)
        return self.exact.findall(s)


class Memo:
    """Results by word, in two generations: the older one goes when the newer has ``size`` entries, so frequent words stay."""

    def __init__(self, size: int):
        self.size = size
        self.of: dict = {}
        self.older: dict = {}

    def missing(self, keys: list) -> list:
        """The keys of neither generation; those of the older one move to the newer."""
        out = []
        for k in set(keys).difference(self.of):
            if k in self.older:
                self.of[k] = self.older.pop(k)
            else:
                out.append(k)
        return out

    def turn(self) -> None:
        """To be called between texts: starts a new generation if this one is full."""
        if len(self.of) >= self.size:
            self.older, self.of = self.of, {}
