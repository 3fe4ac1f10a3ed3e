import hashlib
import random
import struct

import pytest
import tiktoken

from lanemesh.llm import bpe
from lanemesh.llm.queries import tokenizer_path, tokenizer_pattern


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(tokenizer_path())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=tokenizer_pattern(), mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    pool = ["the", " ", "\n\n", "  ", "'ll", "über", "naïve", "0123", "🙂", "ﬁ", "###", "tion", "AbC", "\t", "a", "é", "，", "<|endoftext|>"]
    out = ["", " ", "\n", "a" * 3000, " " * 700 + "x", "ab" * 900, "\r\n \r\n"]
    return out + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 120))) for _ in range(300)]


def test_texts_equal_the_library(ranks, reference):
    coder = bpe.TextEncoder(ranks, tokenizer_pattern())
    for t in texts():
        ids = coder.encode(t)
        assert list(ids) == reference.encode_ordinary(t)
        assert coder.decode(ids) == t.encode()


def test_block_wise_encoding_is_the_same(ranks, monkeypatch):
    coder = bpe.TextEncoder(ranks, tokenizer_pattern())
    whole = [list(coder.encode(t)) for t in texts()]
    monkeypatch.setattr(bpe, "BLOCK_TEXT", 10)
    monkeypatch.setattr(bpe, "BLOCK_PIECES", 7)
    assert [list(coder.encode(t)) for t in texts()] == whole


def test_join_test_agrees_with_merging(ranks):
    coder, rng = bpe.PrefixEncoder(ranks), random.Random(5)
    tokens = [t for t, b in coder.bytes_of.items() if len(b) < 8]
    for _ in range(3000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        both = [coder.bytes_of[a], coder.bytes_of[b]]
        assert coder.may_meet(a, b) == (coder.merged(b"".join(both)) == both)


def test_appends_and_edits_equal_fresh_encodings(ranks):
    rng, coder = random.Random(7), bpe.PrefixEncoder(ranks)
    raw = lambda n: bytes(rng.choice(b"abcdefghinost ") for _ in range(n))
    text = bpe.EditableEncoding(coder, raw(400))
    saved = False
    for _ in range(60):
        if rng.random() < 0.3:
            text.append(raw(rng.randint(0, 12)))
        else:
            a = rng.randint(0, len(text.data))
            b = min(len(text.data), a + rng.randint(0, 9))
            tail = len(text.data) - b
            new = raw(rng.randint(0, 9))
            saved |= text.replace(a, b, new) < len(new) + tail
        assert text.last == coder.table(text.data)
        assert text.ids() == bpe.EditableEncoding(coder, text.data).ids()
    assert saved or coder.longest > 300


def test_documents(spark, ranks, reference):
    docs = [(i, t, "x", "s", 5) for i, t in enumerate(texts()[:60])] + [(900, None, None, None, None), (901, "again", "x", "s", 1), (901, "again", "x", "s", 1), (None, "no id", None, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_tokens long").repartition(3)
    got = bpe.encode_documents(df, ranks, tokenizer_pattern()).collect()
    assert len(got) == len(docs)
    text = {i: t or "" for i, t, *_ in docs}
    for r in got:
        ids = reference.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0), ranks, tokenizer_pattern()).count() == 0
