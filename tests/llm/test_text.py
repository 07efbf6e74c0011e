"""Words, hashes and packing of Arrow columns; connected components; the guard of the entry module."""
import os
import random
import re
import shutil
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from martcraft.llm import text as T
from martcraft.llm.components import connected_components
from martcraft.llm.tables import blocks, unpack
from martcraft.llm.vocab import Memo, Splitter

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0b\r\x1c\xa0é日", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_are_the_patterns_matches(rows):
    column = pa.array(["x y", *rows, " z"], pa.string()).slice(1, len(rows))
    data, off = T.utf8(column)
    w = T.words(data, off)
    want = [(r, m.group()) for r, t in enumerate(rows) for m in WORD.finditer((t or "").encode())]
    assert [(r, bytes(data[s:e])) for r, s, e in zip(w.row, w.start, w.end)] == want
    h = w.hashes()
    known = {}
    for x, (_, b) in zip(h.tolist(), want):
        assert known.setdefault(b, x) == x
    assert len(set(known.values())) == len(known)


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(1, 20))
def test_slices_cover_the_batch(rows, limit):
    batch = pa.RecordBatch.from_pydict({"t": pa.array(rows, pa.string())})
    parts = list(T.slices(batch, "t", limit))
    assert [x for p in parts for x in p.column("t").to_pylist()] == rows
    assert all(p.num_rows == 1 or len(T.utf8(p.column("t"))[0]) <= limit for p in parts)


def test_planes_and_repeats():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 62, 100).astype(np.int64)
    assert (T.unplanes(T.planes(a), np.int64) == a).all()
    k = r.integers(0, 50, 200).astype(np.uint64)
    assert (T.repeated(k) == np.array([(k == x).sum() > 1 for x in k])).all()
    assert T.ngrams(np.zeros(2, dtype=np.uint64), 3).size == 0


def test_splitter_classes_agree_below_u0250():
    for name in "LNSOT":
        s = Splitter("{" + name + "}")
        for c in map(chr, [*range(0x1C), *range(0x20, 0x250)]):
            assert bool(s.latin.findall(c)) == bool(s.exact.findall(c)), (name, c)


def test_memo_keeps_what_is_used():
    m = Memo(3)
    for _ in range(5):
        for w in m.missing(["often"]):
            m.of[w] = 1
        for w in m.missing([random.random(), random.random()]):
            m.of[w] = 0
        m.turn()
        assert len(m.of) <= 3 and len(m.older) <= 5
    assert not m.missing(["often"])


def test_blocks_hold_every_row_once(spark):
    rows = [(i, None if i % 7 == 0 else "word " * (i % 40)) for i in range(300)] + [(None, "x" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = blocks(df, limit=2000).collect()
    assert len({r.block for r in got}) == len(got) > 10
    back = [x for r in got for x in zip(*(unpack(r.payload).column(c).to_pylist() for c in ("id", "text")))]
    assert sorted(back, key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed, monkeypatch):
    from martcraft.llm import components

    r = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(70)]
    edges += [(5, 5), (7, 6), (None, 3)]
    r.shuffle(edges)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    want = sorted((x, find(x)) for x in parent if any(x in e for e in edges if None not in e and e[0] != e[1]))
    df = spark.createDataFrame(edges, "u long, v long").repartition(5)
    assert sorted(tuple(x) for x in connected_components(df).collect()) == want
    # Without any help from contraction inside tasks the rounds alone find them.
    monkeypatch.setattr(components, "HELD", 4)  # more nodes than one task holds: rounds of stars
    assert sorted(tuple(x) for x in connected_components(df).collect()) == want
    monkeypatch.setattr(components, "_contract", lambda batches: batches)
    assert sorted(tuple(x) for x in connected_components(df).collect()) == want
    assert connected_components(df.limit(0)).count() == 0


def test_entry_imports_without_the_subpackage(tmp_path):
    for name in ("martcraft", "__spark_entry__.py"):
        src = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if os.path.isdir(src) else {}))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 20 and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
