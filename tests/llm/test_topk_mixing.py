"""Exact search and source mixing."""
import math
import random
from collections import Counter

import brute
import numpy as np
import pytest
from martcraft.llm.mixing import mix_sources, mixed_documents
from martcraft.llm.topk import bitmaps, top_k, top_rows


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0.0) for i, v in rows], "vec_id long, embedding array<float>, score double").repartition(3)


def test_top_k(spark):
    r = random.Random(2)
    rows = [(i, [float(np.float32(r.uniform(-1, 1))) for _ in range(6)]) for i in range(250)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(400, None), (401, [None] + [0.5] * 5), (402, [math.nan] * 6), (500, [math.inf] * 6), (None, [0.1] * 6), (600, [0.5, 0.25]), (601, [0.5, 0.25]), (700, []), (7, rows[3][1])]
    got = sorted(tuple(x) for x in top_k(vectors(spark, rows)).collect())
    assert got == brute.top_k(rows)
    assert sum(q == 600 for q, *_ in got) == 1  # fewer than k candidates


def test_top_k_blocks_and_scale(spark, monkeypatch):
    from martcraft.llm import topk

    monkeypatch.setattr(topk, "ROWS", 40)
    monkeypatch.setattr(topk, "QUERIES", 3)
    r = random.Random(3)
    rows = [(i * 5, [float(r.choice([-2, -1, 0, 1, 1.5])) for _ in range(4)]) for i in range(150)]
    got = sorted(tuple(x) for x in top_k(vectors(spark, rows), k=4, scale=1, every=25).collect())
    assert got == brute.top_k(rows, 4, 1, 25)


def test_top_rows_against_sorting():
    r = np.random.default_rng(8)
    for _ in range(30):
        n, d = int(r.integers(1, 200)), int(r.integers(1, 5))
        v, q = r.integers(-9, 10, (n, d)), r.integers(-9, 10, (3, d))
        allowed = r.random((3, n)) < 0.8
        for i, chosen in enumerate(top_rows(v, q, allowed, 5)):
            order = sorted(np.flatnonzero(allowed[i]), key=lambda j: (-int(v[j] @ q[i]), j))[:5]
            assert sorted(chosen) == sorted(order)
    assert bitmaps(np.array([True] + [False] * 63 + [True])).tolist() == [1, 1]


def test_top_k_empty_and_large(spark):
    assert top_k(vectors(spark, [(1, None)])).count() == 0
    r = random.Random(6)
    wide = [300000.0, -1e9, 2.0 ** 40, -(2.0 ** 33) - 0.25, 2.0 ** 41]
    rows = [(i * 20, [r.choice([0.5, -0.001, 3.0, 0.0, r.choice(wide) if i % 5 else 2.0]), 1.0, 0.0]) for i in range(90)]
    rows += [(5000, [0.0, 0.0, 1e200]), (5001, [0.0, 0.0, -0.0]), (5100, [0.0, 1e-9, 0.0])]  # of any size, where the products fit
    got = sorted(tuple(x) for x in top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    small = [x for x in rows if x[1][2] < 1]
    assert [x for x in got if x[0] != 5000 and x[2] != 5000] == [x for x in brute.top_k(rows) if x[0] != 5000 and x[2] != 5000]
    assert len(small) == len(rows) - 1 and any(abs(x[3]) > 1 << 40 for x in got)
    with pytest.raises(Exception, match="fit a long"):
        top_k(spark.createDataFrame([(100, [1e18]), (2, [1e18])], "vec_id long, embedding array<double>")).collect()
    with pytest.raises(Exception, match="infinite"):
        top_k(spark.createDataFrame([(100, [1e308]), (2, [1.0])], "vec_id long, embedding array<double>")).collect()


def test_epochs_beyond_an_int(spark):
    from martcraft.llm.mixing import mixing_plan, repeated

    plan = mixing_plan(spark.createDataFrame([("a", 10), ("b", 1)], "skey string, n long"), budget_tokens=10 ** 11, target_entropy=1.0).collect()
    assert {p.skey: p.epochs for p in plan} == {"a": pytest.approx(5e9, rel=1e-5), "b": pytest.approx(5e10, rel=1e-5)}
    df = spark.createDataFrame([(10_000, "x"), (4096, "y"), (1, "z"), (0, "none"), (None, "null")], "times long, run string")
    got = repeated(df, "times", "nth")
    assert got.columns == ["times", "run", "nth"] and dict(got.dtypes)["nth"] == "bigint"
    seen = Counter((x.run, x.nth) for x in got.collect())
    assert seen == Counter({(k, i): 1 for k, n in (("x", 10_000), ("y", 4096), ("z", 1)) for i in range(n)})


def corpus(spark):
    r = random.Random(5)
    rows = []
    for s, n in (("big", 300), ("mid", 60), ("small", 12), (None, 10)):
        rows += [(len(rows) + k, " ".join("w" for _ in range(r.randrange(0, 40))), s) for k in range(n)]
    rows += [(900 + k, t, "void") for k, t in enumerate([None, "", " "])] + [(None, "a b c", "small"), (5, rows[5][1], "big")]
    return rows, spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, source string, epoch int").repartition(4)


def share_of(draws):
    n = Counter()
    for r in draws:
        n[r.source] += r.n_tokens
    return n


def test_entropy_and_budget(spark):
    rows, docs = corpus(spark)
    total = sum(len((t or "").split()) for _, t, _ in rows)
    got = mix_sources(docs, budget_tokens=2 * total, target_entropy=0.9, block_tokens=500).collect()
    n = share_of(got)
    p = np.array(list(n.values())) / sum(n.values())
    assert abs(-(p * np.log(p)).sum() / math.log(4) - 0.9) < 0.02
    assert abs(sum(n.values()) - 2 * total) < 4 * 40  # each source ends with the document that meets its quota
    assert "void" not in n
    # Whole epochs hold every document of their source once.
    per = Counter((r.source, r.epoch, r.doc_id, r.digest) for r in got)
    assert set(per.values()) == {1}
    last = {s: max(r.epoch for r in got if r.source == s) for s in n}
    for s in n:
        units = len({(i, t) for i, t, x in rows if x == s})
        assert all(sum(1 for r in got if (r.source, r.epoch) == (s, e)) == units for e in range(last[s]))
    # Every block holds the sources in about their weights, and its positions run from 0.
    blocks = Counter(r.block for r in got)
    assert set(blocks) == set(range(max(blocks) + 1))
    for b in blocks:
        own = [r for r in got if r.block == b]
        assert sorted(r.position for r in own) == list(range(len(own)))
        assert abs(sum(r.n_tokens for r in own) - 500) < 4 * 40 + 20


def test_repetition_limit(spark):
    rows, docs = corpus(spark)
    tokens = Counter()
    for _, t, s in rows:
        tokens[s] += len((t or "").split())
    got = mix_sources(docs, budget_epochs=1.0, max_repeats=3.0).collect()
    n = share_of(got)
    assert max(n[s] / tokens[s] for s in n) <= 3.0 + 40 / min(t for t in tokens.values() if t)
    assert n["small"] / tokens["small"] > 2.5  # the limit is used


def test_covering_budget(spark):
    rows, docs = corpus(spark)
    got = mixed_documents(docs, max_repeats=2.0)
    assert got.columns == docs.columns
    n = Counter((r.doc_id, r.text, r.source) for r in got.collect())
    want = Counter(r for r in rows if r[2] != "void")
    assert set(n) == set(want)
    assert all(want[k] <= n[k] <= 2 * want[k] for k in want)


def test_mixing_same_result_in_many_buckets(spark, monkeypatch):
    from martcraft.llm import mixing

    _, docs = corpus(spark)
    one = {tuple(r) for r in mix_sources(docs, budget_epochs=1.5, target_entropy=0.8, block_tokens=300).collect()}
    monkeypatch.setattr(mixing, "UNITS_IN_BUCKET", 4)
    assert one == {tuple(r) for r in mix_sources(docs, budget_epochs=1.5, target_entropy=0.8, block_tokens=300).collect()}


def test_mixing_of_nothing(spark):
    _, docs = corpus(spark)
    assert mix_sources(docs.where("doc_id < 0"), budget_epochs=1.0, max_repeats=2.0).count() == 0
    assert mixed_documents(docs.where("source = 'void'"), max_repeats=2.0).count() == 0


def test_mixing_runs_no_python(spark):
    _, docs = corpus(spark)
    plan = mix_sources(docs, budget_epochs=1.0, target_entropy=0.9)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
