"""Byte-level BPE against the rank library, and on nulls, empty and odd tables."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from candleworks.llm import byte_bpe
from candleworks.llm._store import workers_find_package

SCHEMA = "doc_id bigint, text string, ids string, decoded string, lang string"


@pytest.fixture(scope="module")
def lib():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.default_path()), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(byte_bpe.read_ranks(byte_bpe.default_path()), public_tokenizers.PATTERN)


def plain_merges(ranks, word):
    """The merges by the rule: the leftmost pair of the smallest rank, again and again."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_trees_are_the_plain_merges():
    rng = random.Random(5)
    for _ in range(30):
        ranks = {bytes([b]): b for b in range(256)}
        for _ in range(60):  # tokens of any two tokens, over few letters, so that ties and overlaps abound
            a, b = (rng.choice([t for t in ranks if set(t) <= set(b"abc")]) for _ in range(2))
            ranks.setdefault(a + b, len(ranks))
        merger = byte_bpe.Merger(ranks)
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 70))) for _ in range(60)]
        want = [np.array(plain_merges(ranks, w), "<u4").tobytes() for w in words]
        assert merger.many(words) == want
        assert [merger.one(w) for w in words] == want


def test_a_byte_without_a_token_is_refused():
    with pytest.raises(ValueError):
        byte_bpe.Merger({b"a": 0})


def test_encoder_is_the_library(lib, encoder):
    rng = random.Random(3)
    letters = "ab'sT 9.!\x1c\x85\t\n é́İΣς中🙂ﬁ　 "
    odd = ["".join(rng.choice(letters) for _ in range(rng.randrange(120))) for _ in range(800)]
    odd += ["", "a", " " * 700, "\n" * 300 + "a", "é" * 400, "x" * 5000, "ab" * 3000, "x<|endoftext|>y", "I'll don't WE'VE"]
    for t, ids in zip(odd, encoder.encode(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t)
        assert encoder.decode(ids) == t.encode()


def test_slices_change_nothing(lib, encoder, monkeypatch):
    text = " ".join(f"word{i}  \n\t x{i}'s 12 ,;" for i in range(400)) + "  "
    for most in (1, 2, 7, 50):
        parts = list(byte_bpe.slices(text, most))
        assert "".join(parts) == text and len(parts) > 10
        assert [i for p in parts for i in lib.encode_ordinary(p)] == lib.encode_ordinary(text)
    monkeypatch.setattr(byte_bpe, "SLICE_CHARS", 100)
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == lib.encode_ordinary(text)


def test_a_full_cache_keeps_what_is_in_use(lib, monkeypatch):
    enc = byte_bpe.Encoder(byte_bpe.read_ranks(byte_bpe.default_path()), public_tokenizers.PATTERN)
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 50)
    for a in range(0, 2000, 40):
        texts = [f"qzx{i} vbn{i * 7919} kept-word-zq" for i in range(a, a + 40)]
        for t, ids in zip(texts, enc.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t)
        assert len(enc.known) <= 50 + len(enc.whole) + 200


def test_a_million_letters_in_one_piece(lib, encoder):
    ids = encoder.encode(["abcdefghij" * 100_000])[0]
    assert encoder.decode(ids) == b"abcdefghij" * 100_000
    short = encoder.encode(["abcdefghij" * 1000])[0]
    assert np.frombuffer(short, "<u4").tolist() == lib.encode_ordinary("abcdefghij" * 1000)


def test_query_columns(spark, lib):
    workers_find_package(spark)
    texts = [(1, None), (2, ""), (3, "Hello wörld's 12 中文"), (3, "Hello wörld's 12 中文"), (None, "again"), (7, "y" * 40_000)]
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in texts], SCHEMA)
    got = byte_bpe.digests(byte_bpe.encode(docs, byte_bpe.default_path(), byte_bpe.default_pattern())).collect()
    want = []
    for i, t in texts:
        ids = lib.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    none = byte_bpe.digests(byte_bpe.encode(docs.where("false"), byte_bpe.default_path(), byte_bpe.default_pattern()))
    assert none.collect() == [] and none.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
