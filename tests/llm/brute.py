"""Plain Python versions of the operators, to compare with."""
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def substring_dedup(rows, window=13):
    """rows: (id, text); gives (id, n_words, n_removed, kept text) per row. Null ids take no part."""
    least = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def shingles(text, n):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def jaccard(rows, n=3, percent=90):
    """(id, set size, component) per row."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for b in range(a):
            j, t = sets[b]
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                parent[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [(i, len(s), least.get(find(a)) if i is not None else None) for a, (i, s) in enumerate(sets)]


def statistics(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    inside = [False] * len(w)
    for i, g in enumerate(grams):
        if often[g] > 1:
            inside[i:i + 5] = [True] * 5
    n, r = len(w), sum(inside)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, r, n < 10 or 100 * r > 20 * n


def lines_of(text):
    return [(x.strip(" \t\n\r\x0b\x0c"), k, len(words(x))) for k, x in enumerate((text or "").split("\n")) if words(x)]


def line_dedup(rows, min_words=10):
    """(id, kept text, lines, removed lines) per row: every document is compared with every earlier one, line by line."""
    lines = [lines_of(t) for _, t in rows]
    places = {}  # of each line: the documents and places that have it
    for d, ls in enumerate(lines):
        for q, x in enumerate(ls):
            places.setdefault(x[0], []).append((d, q))
    out = []
    for d, (i, t) in enumerate(rows):
        s, gone = lines[d], set()
        for p in range(len(s)):
            for e, q in places[s[p][0]] if i is not None else ():
                j, o = rows[e][0], lines[e]
                if j is None or j >= i or p and q and s[p - 1][0] == o[q - 1][0]:
                    continue  # a block from here is part of a longer one
                n = 0
                while p + n < len(s) and q + n < len(o) and s[p + n][0] == o[q + n][0]:
                    n += 1
                if sum(x[2] for x in s[p:p + n]) >= min_words:
                    gone |= set(range(p, p + n))
        drop = {s[g][1] for g in gone}
        for g in gone:
            if g + 1 in gone:
                drop |= set(range(s[g][1], s[g + 1][1]))
        out.append((i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop), len(s), len(gone)))
    return out


def top_k(rows, k=10, scale=1024, every=100):
    import math

    use = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = defaultdict(list)
    for i, q in use:
        if i % every == 0:
            out[i] += [(-sum(a * b for a, b in zip(q, v)), j) for j, v in use if j != i and len(v) == len(q)]
    return sorted((i, r + 1, j, -s) for i, found in out.items() for r, (s, j) in enumerate(sorted(found)[:k]))
