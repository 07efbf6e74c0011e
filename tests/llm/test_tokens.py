"""Token counts and the BPE codec against the tokenizers library."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from martcraft.llm.bpe import encode_decode
from martcraft.llm.token_count import Counter, count_tokens
from martcraft.llm.vocab import Vocabulary
from tokenizers import Tokenizer

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    odd = ["", " ", "a", "\n\n x", "<|endoftext|>x<|startoftext|> Y", "<|endoftext", "a" * 3000, "ab" * 2000, "É é ΑΣ ΑΣ. İI ß ﬁ\xa0x y\x1cz \x85 q",
           "日本語 テキスト 12345 ½ ²", "it's I'LL we've 'S", "🙂 👩‍👩‍👧", "é Ａ"]
    pool = [range(1, 128), range(128, 0x600), range(0x1E00, 0x3100), [32, 39, 115, 10]]
    return odd + ["".join(chr(r.choice(r.choice(pool))) for _ in range(40)) for _ in range(200)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate([*texts, None])], "doc_id long, text string, n_tokens int").repartition(3)


def test_counts(spark, texts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    texts = texts + [r.text for r in docs.collect()]
    got = {r.doc_id: r for r in count_tokens(frame(spark, texts), BYTE, limit=30).collect()}
    want = [len(e.ids) for e in Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)]
    assert [got[i].n_tokens for i in range(len(texts))] == want
    assert [got[i].n_bytes for i in range(len(texts))] == [len(t.encode()) for t in texts]
    assert all(got[i].over_limit == (got[i].n_tokens > 30) for i in got)
    assert tuple(got[len(texts)])[1:] == (0, 0, False)


def test_codec(spark, texts):
    got = {r.doc_id: r for r in encode_decode(frame(spark, texts), WORD).collect()}
    t = Tokenizer.from_file(WORD)
    for i, e in enumerate(t.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(got[i].ids, dtype="<u4").tolist() == e.ids
        assert got[i].n_tokens == len(e.ids)
        assert got[i].decoded == t.decode(e.ids, skip_special_tokens=False)
    assert (got[len(texts)].n_tokens, bytes(got[len(texts)].ids), got[len(texts)].decoded) == (0, b"", "")


def test_merges_with_one_product_go_one_by_one():
    """Two merges make "abc"; the order of single merges then matters."""
    from martcraft.llm.vocab import byte_symbols

    names = [*byte_symbols(), "ab", "bc", "abc", "abca"]
    merges = [("b", "c"), ("a", "b"), ("ab", "c"), ("abc", "a"), ("a", "bc")]
    c = Counter(Vocabulary({t: i for i, t in enumerate(names)}, merges, [], ""))
    assert not c.all_places
    assert c.merged(["abcabc", "abc", "x"]).tolist() == [2, 1, 1]


def test_empty_tables(spark, texts):
    none = frame(spark, texts).where("doc_id < 0")
    assert count_tokens(none, BYTE).count() == encode_decode(none, WORD).count() == 0


def test_registered_digests(spark):
    from martcraft.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op10_bpe_codec"](spark, "/root/testdata/sf0.001").collect()}
    t = Tokenizer.from_file(WORD)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = t.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
