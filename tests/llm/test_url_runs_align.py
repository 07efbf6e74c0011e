"""URL filters, periodic runs and token alignment against plain Python."""
import hashlib
import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from martcraft.llm import text as T
from martcraft.llm import token_align
from martcraft.llm.periodic_runs import find_runs, word_runs
from martcraft.llm.queries import QUERIES, URL_RULES
from martcraft.llm.token_align import align_tokens
from martcraft.llm.url_filter import filter_urls, rule_table
from tokenizers import Tokenizer

SMALL = "/root/testdata/sf0.001"
BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# URL filters

def judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        k = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k]), rest[k:]
        path = rest[:min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, default)))


ODD_URLS = [None, "", "x", "http:/a.com/", "://", "http://", "http://a.com", "http://com/", "http://.com/x", "http://a..com/x", "http://a.com./x", "http://A.COM:80/",
            "HTTP://WWW.EXAMPLE.com/en/", "http://www.example.com/EN/", "http://www.example.com/en", "http://a.www.example.com/en/?x=/es/", "http://example.com//en/", "a://b://c.net/fr/",
            "http://x.net/es/#a", "http://net/fr/\n/x", "http://u@x.com/é", "//x.com/", "http://notexample.com/en/a", "http://x.com?y/en/", "http://x.net#/es/", "http://É.COM/en/", "http://x.com/\x00"]


def test_urls_by_the_contract_rules(spark):
    pages = spark.createDataFrame([(i, u, "kept", 1) for i, u in enumerate([*ODD_URLS, *ODD_URLS[:9]])], "page_id long, url string, host string, Rule int")
    got = filter_urls(pages, rule_table(spark, URL_RULES), default="block")
    assert got.columns == ["page_id", "url", "host", "Rule", "host_", "path", "rule_", "verdict"]
    rows = got.collect()
    assert len(rows) == len(ODD_URLS) + 9
    for r in rows:
        assert tuple(r)[4:] == judge(r.url, URL_RULES, "block"), r.url


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_urls_by_many_rules(spark, broadcast):
    r = random.Random(3)
    labels, parts = ["a", "b", "com", "net", "co", "x-y"], ["", "a", "ab", "abc", "b", "é"]
    host = lambda: ".".join(r.choice(labels) for _ in range(r.randrange(1, 5)))
    path = lambda: "".join("/" + r.choice(parts) for _ in range(r.randrange(4)))
    rules = list(dict.fromkeys((host(), path(), r.choice(["allow", "block"])) for _ in range(400)))
    rules += [(h, p, "block") for h, p, v in rules[:20] if v == "allow"]  # both verdicts: block wins
    urls = [f"http://{host()}{path()}{r.choice(['', '?a', '#/b'])}" for _ in range(500)] + ["http://b.a.com/a/ab"] * 400
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3), rule_table(spark, rules)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len(got) == len(urls)
    assert {tuple(x)[2:] for x in got} == {judge(u, rules) for u in urls}
    for x in got:
        assert tuple(x)[2:] == judge(x.url, rules)


def test_urls_very_long_empty_and_bad_rules(spark):
    urls = ["http://" + "a." * 50_000 + "com/" + "/x" * 50_000, "http://" + "c" * 200_000, "x" * 200_000 + "://net/es/"]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    got = filter_urls(pages, rule_table(spark, URL_RULES)).collect()
    assert [tuple(r)[1:] for r in got] == [judge(u, URL_RULES) for u in urls]
    assert filter_urls(pages.where("url is null"), rule_table(spark, URL_RULES)).count() == 0
    assert {tuple(r)[3:] for r in filter_urls(pages, rule_table(spark, [])).collect()} == {(None, "allow")}
    for bad in [("", "/", "allow"), ("a", "x", "allow"), ("a", "/", "deny"), ("a", None, "block"), (None, "", "block"), ("a/b", "/", "allow")]:
        with pytest.raises(ValueError):
            filter_urls(pages, rule_table(spark, [bad]))


# Periodic runs

def all_runs(w, min_length=24, exponent=3):
    """(start, length, period) of every run, by comparing each word with the one q places on, for all q."""
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(min_length, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def strongest(runs):
    best = None
    for s, n, q in runs:
        if best is None or (n * best[2], -s, -q) > (best[1] * q, -best[0], -best[2]):
            best = (s, n, q)
    return (*best, 1000 * best[1] // best[2]) if best else (None,) * 4


def periodic_words(r):
    k, w = r.choice([1, 2, 2, 3, 4, 50]), []
    for _ in range(r.randrange(6)):
        u = [r.randrange(k) for _ in range(r.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 13, 16, 20, 24, 29, 40, 61]))]
        if r.random() < 0.3:
            u = u * r.randrange(1, 5) + [r.randrange(k)]
        w += u * r.randrange(1, 6) + u[:r.randrange(len(u) + 1)]
        if r.random() < 0.3:
            w += [r.randrange(99) for _ in range(r.randrange(9))]
    return w * r.randrange(2, 5) if r.random() < 0.2 else w


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_every_period(seed):
    r, n = random.Random(seed), 0
    for _ in range(6):
        docs = [periodic_words(r) for _ in range(25)]
        flat = np.array([x for d in docs for x in d], dtype=np.uint64)
        off = np.append(0, np.cumsum([len(d) for d in docs]))
        for least, exponent in ((24, 3), (3, 3), (10, 5)):
            got = [tuple(x) for x in word_runs(T.mix(flat + T.U(1)), off, least, exponent).tolist()]
            want = [(k, *x) for k, d in enumerate(docs) for x in all_runs(d, least, exponent)]
            assert got == want
            n += len(want)
    assert n > 500


def test_runs_in_small_chunks(monkeypatch):
    from martcraft.llm import periodic_runs

    monkeypatch.setattr(periodic_runs, "CHUNK", 50)
    test_runs_of_every_period(9)


def test_exponents_below_three_are_refused():
    with pytest.raises(ValueError):
        word_runs(np.zeros(9, dtype=np.uint64), np.array([0, 9]), 3, 2)


def test_runs_of_texts(spark):
    r = random.Random(8)
    sep = [" ", "  ", "\n", "\t\r\n", "\x0b\x0c"]
    texts = ["".join(f"wé{x}" + r.choice(sep) for x in periodic_words(r)) for _ in range(60)] + [None, "", " \n", "a", "\xa0 " * 30, "x " * 5000 + "y " * 5000, "a b c d e f g h i j k l m " * 4000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(3, texts[3], ""), (None, texts[5], "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    got = sorted(find_runs(docs).collect(), key=lambda x: (x.doc_id is None, x.doc_id or 0))
    assert len(got) == len(rows)
    for x in got:
        w = brute.words(texts[5 if x.doc_id is None else x.doc_id])
        runs = all_runs(w) if len(w) < 9000 else None
        if runs is None:
            runs = [(0, 5000, 1), (5000, 5000, 1)] if len(w) == 10_000 else [(0, 52_000, 13)]
        assert (x.n_runs, [tuple(z) for z in x.runs], x.collapsed) == (len(runs), runs, collapsed(w, runs))
        assert (x.start, x.length, x.period, x.exponent_milli) == strongest(runs)
    assert find_runs(docs.where("doc_id < 0")).count() == 0


def planted(i, text):
    w = brute.words(text)
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def test_registered_runs(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    n = 0
    for d in docs:
        w, x = planted(d.doc_id, d.text), got[d.doc_id]
        runs = all_runs(w)
        n += len(runs)
        assert (x.n_runs, x.start, x.length, x.period, x.exponent_milli) == (len(runs), *strongest(runs))
        assert x.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert x.collapsed_sha256 == sha(collapsed(w, runs))
    assert n > 10


# Token alignment

class Tokens:
    def __init__(self):
        self.a = Tokenizer.from_file(BYTE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}

    def __call__(self, text):
        """The groups of both ids; none where the bytes differ."""
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        raw_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in b)]
        if {b"".join(raw_a), b"".join(raw_b)} != {(" " + text).encode()}:
            return []
        out, x, y, i, j, at, bt = [], [], [], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if at <= bt and i < len(a):
                x.append(a[i])
                at += len(raw_a[i])
                i += 1
            else:
                y.append(b[j])
                bt += len(raw_b[j])
                j += 1
            if at == bt:
                out.append((x, y))
                x, y = [], []
        return out


def aligned(texts):
    tokens = Tokens()
    groups = [tokens(t) for t in texts]
    links = [Counter((p, q) for x, y in g for p in x for q in y) for g in groups]
    count = Counter(k for own in links for k in own)
    top = Counter()
    for (p, _), n in count.items():
        top[p] = max(top[p], n)
    return [(sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()), sum(n for k, n in own.items() if count[k] == top[k[0]]),
             sum(n * count[k] for k, n in own.items()), ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)) for g, own in zip(groups, links, strict=True)]


def odd_texts():
    r = random.Random(6)
    pool = [range(1, 128), range(128, 0x600), range(0x1E00, 0x3100), range(0x4E00, 0x9000), range(0x1F300, 0x1F700), [32, 32, 39, 115, 10, 0x2581, 0xA0]]
    fixed = ["", " ", "  ", "a", " a", "a ", "\n", "<|endoftext|> <s></s><unk> <0x41>", "▁a ▁", "a  b\n\n c\t d", "日本語 テキスト 12345 ½ ²", "🙂👩‍👩‍👧 x", "x" * 3000, "日" * 3000, "aé" * 1500,
             "é Ａ ﬁ", "the cat the cat sat", "\x00a", "a\r\nb"]
    return fixed + ["".join(chr(r.choice(r.choice(pool))) for _ in range(r.randrange(60))) for _ in range(150)] + ["".join(chr(r.choice(pool[0])) for _ in range(50)) for _ in range(60)]


@pytest.mark.parametrize("block", [1, 2000, 4 << 20])
def test_alignment_of_odd_texts(spark, monkeypatch, block):
    monkeypatch.setattr(token_align, "BLOCK_BYTES", block)  # the closure carries it to the tasks
    texts = [*odd_texts(), None]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, groups string, block int").repartition(2)
    got = {r.doc_id: tuple(r)[1:] for r in align_tokens(docs, BYTE, PIECE).collect()}
    assert [got[i] for i in range(len(texts))] == aligned(texts)


def test_alignment_of_repeated_rows_null_ids_and_wide_groups(spark, monkeypatch):
    monkeypatch.setattr(token_align, "WIDE_GROUP", 2)
    texts = ["the cat sat", "the cat sat", "日本語日本語 the", "a cat", None, "żółć żółć gęślą"]
    ids = [1, 1, None, 2, 3, 4]
    got = align_tokens(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").coalesce(1), BYTE, PIECE).collect()
    assert [tuple(r)[1:] for r in got] == aligned(texts)
    assert [r.doc_id for r in got] == ids
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE).count() == 0
    wide = token_align.Windows(np.array([5, 6, 5, 9]), np.array([3, 3, 1]), np.array([3, 1]), np.array([2, 1]), np.array([1, 1]))
    pair, times, size = wide.links()
    assert dict(zip(pair.tolist(), times.tolist(), strict=True)) == {5 << 32 | 3: 4, 6 << 32 | 3: 2, 9 << 32 | 1: 1}
    assert size.tolist() == [2, 1]


def test_windows_with_equal_hashes_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(token_align.T, "mix", lambda x: np.zeros(len(x), dtype=np.uint64))
    with open(BYTE, encoding="utf-8") as f, open(PIECE, "rb") as g:
        aligner = token_align.Aligner(f.read(), g.read())
    texts = [t for t in odd_texts() if t]
    coded = [(np.array(a, dtype=np.int32), np.array(b, dtype=np.int32)) for a, b in aligner.encode(texts)]
    packed, pairs, counts = aligner.block(list(range(len(texts))), coded)
    got = token_align.score(packed, pairs, counts, np.ones(len(pairs), dtype=np.int64)).to_pylist()
    assert [(r["n_links"], r["groups"]) for r in got] == [(x[3], x[6]) for x in aligned(texts)]


def test_registered_alignment(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_token_alignment"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = aligned([d.text for d in docs])
    assert got == {d.doc_id: (*w[:6], sha(w[6]) if w[0] else "") for d, w in zip(docs, want, strict=True)}
