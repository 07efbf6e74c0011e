"""The pipeline's stages against plain Python, and the registered queries."""
import hashlib
from collections import Counter

import brute
import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from martcraft.llm import quality
from martcraft.llm.queries import ORACLE, QUERIES
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SMALL = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before and after every stage."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.saved(stage(spark, docs, SMALL), name)
        out[name] = docs, after
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stage_names():
    assert list(STAGE) == ["quality_rules", "line_dedup", "near_duplicates", "source_mixing", "bpe_codec"]


def test_quality_rules(spark, steps):
    before, after = steps["quality_rules"]
    assert after.schema == before.schema
    model = quality.train(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    want = [r.doc_id for r in quality.judge(before, model).collect() if r.kept]
    assert ids(after) == sorted(want)
    failed = {r.doc_id for r in before.collect() if brute.statistics(r.text)[-1]}
    assert failed and not failed & set(want)
    assert len(want) > 0.75 * before.count()


def test_line_dedup(steps):
    before, after = steps["line_dedup"]
    assert after.schema == before.schema
    want = {i: t for i, t, n, gone in brute.line_dedup([(r.doc_id, r.text) for r in before.collect()]) if gone < n or not gone}
    got = after.collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_near_duplicates(steps):
    before, after = steps["near_duplicates"]
    groups = brute.jaccard([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert ids(after) == sorted(i for i, _, c in groups if i == c)


def test_source_mixing(steps):
    before, after = steps["source_mixing"]
    rows, drawn = Counter(tuple(r) for r in before.collect()), Counter(tuple(r) for r in after.collect())
    assert set(rows) == set(drawn)
    tokens = Counter()
    for r in before.collect():
        tokens[r.source] += len(brute.words(r.text))
    got = Counter()
    for r in after.collect():
        got[r.source] += len(brute.words(r.text))
    most = max(len(brute.words(r.text)) for r in before.collect())
    repeats = {s: got[s] / tokens[s] for s in tokens}
    assert min(repeats.values()) >= 1 and all(got[s] <= 2 * tokens[s] + most for s in tokens)


def test_bpe_codec(steps):
    before, after = steps["bpe_codec"]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in before.collect():
        e = t.encode(r.text, add_special_tokens=False).ids
        want[r.doc_id, len(e), np.array(e, dtype="<u4").tobytes(), hashlib.sha256(t.decode(e, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in after.collect()) == want


def test_run_is_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SMALL)
    assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in steps["bpe_codec"][1].collect())


def test_stages_on_odd_tables(spark):
    text = " ".join(f"word{i}" for i in range(40))
    copy = text.replace("word3 ", "other ")
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, copy, None, None, None), (3, None, "en", "a", None), (4, "", None, "b", 0), (None, text + " x", "en", None, 1),
            (6, " ".join(f"own{i}\n" for i in range(3000)), "de", "c", 7)]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = base.selectExpr("*", "1 as kept", "2 as n_lines", "3 as times", "'x' as digest", "4 as component_id", "5 as cls", "array(1) as ids", "6 as n_tokens", "7 as epoch", "8 as id",
                          "9 as dropped_id")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, SMALL)
        n = got.count()
        if name != "bpe_codec":
            assert got.columns == odd.columns, name
        assert n >= 3, name
        assert stage(spark, odd.where("doc_id > 99"), SMALL).count() == 0, name
    kept = {r.doc_id for r in STAGE["near_duplicates"](spark, odd, SMALL).collect()}
    assert kept == {None, 1, 3, 4, 6}


def test_near_duplicates_by_row(spark):
    """Rows of one doc_id are judged by their own texts; repeated rows are one; nothing else goes."""
    a = " ".join(f"a{i}" for i in range(60))
    near, b, c = a + " end", " ".join(f"b{i}" for i in range(50)), " ".join(f"c{i}" for i in range(50))
    rows = [(1, a, "x"), (2, near, "x"), (2, b, "x"),        # 2: a near copy of 1, and a text of its own
            (3, c, "x"), (3, c, "y"), (3, c + " z", "x"),    # 3: copies and a near copy under one doc_id
            (4, c, "x"), (5, None, "x"), (5, "", "x"), (5, a, "x"), (6, None, "x"), (None, a, "x"), (None, a, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"cls": F.lit(1), "judged_id": F.lit(2), "k": F.lit(3), "row": F.create_map(F.lit("m"), F.lit(4))})
    got = STAGE["near_duplicates"](spark, docs, SMALL)
    assert got.columns == docs.columns
    left = Counter((r.doc_id, r.text) for r in got.collect())
    threes = [k for k in left if k[0] == 3]
    assert len(threes) == 1 and threes[0][1] in (c, c + " z") and left.pop(threes[0]) == 1
    assert left == Counter([(1, a), (2, b), (5, None), (5, ""), (6, None), (None, a), (None, a)])
    again = STAGE["near_duplicates"](spark, docs.repartition(5), SMALL)
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracles(spark, name, sf):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '/root/testdata/{sf}/{t}.parquet'")
    got = QUERIES[name](spark, f"/root/testdata/{sf}")
    want = con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, want.project(", ".join(cols)).fetchall()))


def test_registered_contract_queries(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {tuple(r) for r in QUERIES["op3_substring_dedup"](spark, SMALL).collect()}
    assert got == {(i, n, m, sha(t)) for i, n, m, t in brute.substring_dedup(docs)}
    assert {tuple(r) for r in QUERIES["op6_jaccard_join"](spark, SMALL).collect()} == set(brute.jaccard(docs))
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, SMALL).collect()}
    for i, t in docs:
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute.statistics(t)
    toxic = {r.doc_id: r.toxic for r in QUERIES["op8_toxicity"](spark, SMALL).collect()}
    assert len(toxic) == len(docs)
    got = {tuple(r) for r in QUERIES["op7_line_dedup"](spark, SMALL).select("doc_id", "n_lines", "n_removed_lines", "kept_sha256").collect()}
    assert got == {(i, n, m, sha(t)) for i, t, n, m in brute.line_dedup(docs)}
