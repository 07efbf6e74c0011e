"""Substring dedup, Jaccard join and line dedup against plain Python."""
import random

import brute
import pytest
from martcraft.llm.jaccard_join import jaccard_components
from martcraft.llm.line_dedup import dedup_lines
from martcraft.llm.substring_dedup import dedup_substrings

SCHEMA = "doc_id long, text string, source string"


def planted(seed, n=60, vocabulary=40):
    """Random texts over few words with shared passages, near and exact copies, and odd rows."""
    r = random.Random(seed)
    word = [f"w{i}" for i in range(vocabulary)]
    passages = [[r.choice(word) for _ in range(r.choice([12, 13, 14, 30, 60]))] for _ in range(4)]
    rows = []
    for i in range(n):
        w = [f"u{r.randrange(900)}" if r.random() < 0.5 else r.choice(word) for _ in range(r.randrange(0, 120))]
        if r.random() < 0.6:
            p, at = r.choice(passages), r.randrange(len(w) + 1)
            w[at:at] = p[r.randrange(3):len(p) - r.randrange(3)]
        if rows and r.random() < 0.4:
            w = (r.choice(rows)[1] or "").split()
            for _ in range(r.choice([0, 0, 1, 3])):
                if w:
                    w[r.randrange(len(w))] = "edit"
        sep = [" ", "\n", "  ", "\t", "\n\n", " \n"]
        rows.append((i * 3 + 1, "".join(x + r.choice(sep if k % 7 == 0 else [" "]) for k, x in enumerate(w))))
    r.shuffle(rows)
    return [*rows, (500, None), (501, ""), (502, " \n\t "), (503, "Ünï one"), (504, "ÜNÏ ONE"), (505, "ünï One"), (None, rows[0][1]), (None, None)]


@pytest.fixture(params=[1, 2, 3])
def rows(request):
    return planted(request.param)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "s") for i, t in rows], SCHEMA).repartition(parts)


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0], str(r)))


def test_substrings(spark, rows):
    got = dedup_substrings(frame(spark, rows)).collect()
    assert by_id((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == by_id(brute.substring_dedup(rows))
    for r in got:  # factors are whole windows of smaller documents
        assert all(f.n_words >= 13 and f.source < r.doc_id for f in r.factors)


def test_substrings_short_window_and_one_block(spark, rows):
    got = dedup_substrings(frame(spark, rows, 1), window=6).collect()
    assert by_id((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == by_id(brute.substring_dedup(rows, 6))


def test_substrings_common_sequences(spark, monkeypatch):
    """One sequence of words in many documents and company, over several blocks and shards."""
    from martcraft.llm import substring_dedup, tables

    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 4000)
    monkeypatch.setattr(tables.blocks, "__defaults__", (*tables.blocks.__defaults__[:2], 1500))
    r = random.Random(11)
    common = [[f"c{k}{i}" for i in range(n)] for k, n in enumerate((5, 8, 12, 13, 15))]
    rows = []
    for i in range(120):
        w = [f"x{r.randrange(400)}" for _ in range(r.randrange(5, 40))]
        for c in r.sample(common, 2):
            at = r.randrange(len(w))
            w[at:at] = c + ([f"y{r.randrange(3)}"] if r.random() < 0.5 else [])
        rows.append((r.randrange(1, 10**9), " ".join(w)))
    got = dedup_substrings(frame(spark, rows, 4)).collect()
    want = brute.substring_dedup(rows)
    assert by_id((x.doc_id, x.n_words, x.n_removed, x.kept_text) for x in got) == by_id(want)
    assert sum(x[2] for x in want) > 500


def test_substrings_repeated_ids(spark):
    t = " ".join(f"a{i}" for i in range(20))
    rows = [(5, t), (5, t), (7, t + " tail"), (2, "short")]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in dedup_substrings(frame(spark, rows)).collect()]
    assert by_id(got) == by_id(brute.substring_dedup(rows))
    assert (7, 21, 20, "tail") in got


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_jaccard(spark, rows, n, percent):
    got = [tuple(r) for r in jaccard_components(frame(spark, rows), n=n, percent=percent).collect()]
    assert by_id(got) == by_id(brute.jaccard(rows, n, percent))


def test_jaccard_large_group(spark):
    """More near copies than a tile holds, linked in chains and apart, and many exact copies."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(700):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 6])):
            w[r.randrange(len(w))] = f"e{r.randrange(60)}"
        rows.append((i, " ".join(w)))
    got = [tuple(x) for x in jaccard_components(frame(spark, rows)).collect()]
    assert by_id(got) == by_id(brute.jaccard(rows))


def test_lines(spark, rows):
    got = dedup_lines(frame(spark, rows)).collect()
    assert by_id((r.doc_id, r.text, r.n_lines, r.n_removed_lines) for r in got) == by_id(brute.line_dedup(rows))


def test_lines_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed_lines) for r in dedup_lines(docs).collect()]
    want = brute.line_dedup(rows)
    assert by_id(got) == by_id(want)
    assert sum(w[3] for w in want) > 0


def test_lines_same_id_other_texts(spark):
    a = "one two three four five six\nseven eight nine ten eleven twelve"
    rows = [(1, a), (4, a), (4, "zero\n" + a), (4, "own words only, nothing shared at all here")]
    got = sorted(r.text for r in dedup_lines(frame(spark, rows)).collect() if r.doc_id == 4)
    assert got == ["", "own words only, nothing shared at all here", "zero"]


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x", 1.5), (2, "a b", 8, None, None)], "doc_id long, text string, n_lines int, sigs string, block double")
    got = dedup_lines(df)
    assert got.columns == [*df.columns, "n_lines_", "n_removed_lines", "n_removed_words"]
    assert {r.n_lines for r in got.collect()} == {7, 8}
    assert dedup_substrings(df).count() == jaccard_components(df).count() == 2
    none = df.where("doc_id > 9")
    assert dedup_lines(none).count() == dedup_substrings(none).count() == jaccard_components(none).count() == 0


def test_every_factor_stands_in_its_source(spark):
    r = random.Random(12)
    w = [f"w{i}" for i in range(1, 200)]
    rows = [(1, " ".join(w[:14])), (2, " ".join(w[1:15])), (3, " ".join(w[:15]))]  # no document has all fifteen words
    rows += [(i, t) for i, t in ((r0.doc_id + 10, r0.text) for r0 in spark.read.parquet(f"/root/testdata/sf0.001/documents.parquet").collect())]
    passages = [[r.choice(w) for _ in range(r.randrange(13, 60))] for _ in range(12)]
    rows += [(10_000 + i, " ".join(x for _ in range(4) for x in (r.choice(passages)[r.randrange(5):] + [f"own{i}"] * r.randrange(3)))) for i in range(120)]
    text = {i: f" {' '.join(brute.words(t))} " for i, t in rows}
    got = dedup_substrings(frame(spark, rows)).collect()
    n = 0
    for x in got:
        own, covered = brute.words(text[x.doc_id]), set()
        for f in x.factors:
            assert f.n_words >= 13 and f.source < x.doc_id
            assert f" {' '.join(own[f.start:f.start + f.n_words])} " in text[f.source]
            covered |= set(range(f.start, f.start + f.n_words))
            n += 1
        assert len(covered) == x.n_removed
    assert n > 200
    assert {f.source for x in got if x.doc_id == 3 for f in x.factors} == {1, 2}
