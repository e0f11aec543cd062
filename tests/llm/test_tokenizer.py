import os
import random

import pytest
import tiktoken

from tracewright.llm import tokenizer as K

pytestmark = pytest.mark.skipif(not os.path.exists(os.path.join(K.FOLDER, K.VOCABULARY)), reason="no vocabulary here")


@pytest.fixture(scope="module")
def tokens():
    return K.read_vocabulary()


@pytest.fixture(scope="module")
def reference(tokens):
    return tiktoken.Encoding("own", pat_str=K.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


ODD = ["", " ", "\n\n \t", "a\x1cb \x1fc", "don't I'LL we've", "<|endoftext|>", "naïve café 東京 　x y z\u0085q", "🙂🙃 é ​﻿", "x" * 3000, "12345 ½ Ⅷ ٣", "\r\n  tail  ", "     ok"]


def test_equal_to_the_reference(tokens, reference):
    enc = K.Encoder(tokens)
    rng = random.Random(1)
    texts = ODD + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(128, 0x3000), rng.randrange(0x4E00, 0x9FFF), 32, 10])) for _ in range(rng.randrange(1, 80))) for _ in range(800)]
    assert enc.encode_batch(texts) == [reference.encode_ordinary(t) for t in texts]
    assert enc.count_batch(texts) == [len(x) for x in enc.encode_batch(texts)]
    assert all(b"".join(tokens[i] for i in ids).decode() == t for t, ids in zip(texts, enc.encode_batch(texts), strict=True))


def test_memo_is_bounded(tokens, reference):
    enc = K.Encoder(tokens, memo=50)
    for i in range(20):
        t = " ".join(f"w{i}x{j}" for j in range(30))
        assert enc.encode_batch([t]) == [reference.encode_ordinary(t)]
    assert len(enc.memo) < 300


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"k{i}".encode() for i in range(5000)]
    h = K.PerfectHash(keys)
    assert sorted(h.values.tolist()) == list(range(5000))
    assert h.find(keys) == list(range(5000)) and h.find([b"x", b"k5000", b""]) == [-1] * 3
    assert K.PerfectHash([]).find([b"a"]) == [-1] and K.PerfectHash([b"a"]).find([b"a", b"b"]) == [0, -1]


def test_table(spark, reference):
    df = spark.createDataFrame([(1, "hello there", "x", [9]), (2, None, "x", [9]), (3, "", "x", [9]), (3, "", "x", [9])], "doc_id bigint, text string, n_tokens string, ids array<int>")
    got = sorted((r["doc_id"], r["ids"]) for r in K.encode_column(df, "doc_id", "text").collect())
    assert got == [(1, reference.encode_ordinary("hello there")), (2, []), (3, []), (3, [])]
    assert {(r["doc_id"], r["n_tokens"]) for r in K.encode_column(df, "doc_id", "text", counts_only=True).collect()} == {(1, 2), (2, 0), (3, 0)}
    assert K.encode_column(df.filter("false"), "doc_id", "text").count() == 0


def test_whole_table(spark, data, reference):
    df = spark.read.parquet(f"{data}/documents.parquet")
    ids = {r["doc_id"]: r["ids"] for r in K.encode_column(df, "doc_id", "text").collect()}
    assert all(ids[r["doc_id"]] == reference.encode_ordinary(r["text"] or "") for r in df.collect())
