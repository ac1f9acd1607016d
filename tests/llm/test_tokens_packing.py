"""Piece encoding against the library, and packing by exact round trips."""

import random
import time

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from txscore.llm import harmonic, piece_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def model():
    return piece_tokens.PieceModel(MODEL)


def random_texts(n):
    rng = random.Random(3)
    pool = list(" \n▁ab1é梦😀\x00\ttheing—ñß<>²½_.,") + [" "] * 8 + ["the", "ing", "  ", "----", "▁▁", "२"]
    return ["".join(rng.choices(pool, k=rng.randint(0, 50))) for _ in range(n)]


def test_encoder_equals_library(model):
    texts = random_texts(4000) + ["", " ", "   ", " " * 999, "a" * 3000, "ab" * 700 + " " * 33 + "x", "\n\n",
                                  "".join(chr(c) for c in range(1, 0x3000))]
    sp = SentencePieceProcessor(model_file=MODEL)
    for kept in (150_000, 300):  # the small tables are dropped again and again
        encoder = piece_tokens.Encoder(model, kept)
        for i in range(0, len(texts), 500):
            part = texts[i:i + 500]
            ids, decoded = encoder(part)
            want = sp.encode(part, num_threads=1)
            assert [np.frombuffer(x, np.int32).tolist() for x in ids] == want
            assert decoded == sp.decode(want)


def test_long_units_equal_library(model, monkeypatch):
    rng = random.Random(5)
    sp = SentencePieceProcessor(model_file=MODEL)
    texts = ["a" * 30_000, "ab" * 20_000, "=" * 9000 + "\n" + "-" * 5001,
             "".join(rng.choices("etaoinshrdlu", k=200_000)),
             "one " + "".join(rng.choices("äßé漢字аб\U0001f600xyz", k=20_000)) + " two  three",
             *("".join(rng.choices("the", k=piece_tokens.LONG + d)) for d in (-1, 0, 1))]
    started = time.perf_counter()
    ids, decoded = piece_tokens.Encoder(model)(texts)
    assert time.perf_counter() - started < 20
    monkeypatch.setattr(piece_tokens, "KEPT_CHARS", 50)
    monkeypatch.setattr(piece_tokens, "ROUND_CHARS", 30)
    monkeypatch.setattr(piece_tokens, "LONG", 3)
    monkeypatch.setattr(piece_tokens, "BLOCK", 4)
    words = ["".join(rng.choices("etaoinsh", k=rng.randint(1, 40))) for _ in range(300)]
    small = [" ".join(rng.choices(words, k=20)) for _ in range(40)]
    encoder = piece_tokens.Encoder(model)
    more = [encoder(small[i:i + 4]) for i in range(0, 40, 4)]
    ids, decoded = ids + [x for a, _ in more for x in a], decoded + [x for _, b in more for x in b]
    for t, x, y in zip(texts + small, ids, decoded, strict=True):
        want = sp.encode(t)
        assert np.frombuffer(x, np.int32).tolist() == want and sp.decode(want) == y


def test_decoder_equals_library(model):
    rng = random.Random(4)
    sp = SentencePieceProcessor(model_file=MODEL)
    ids = [[rng.randrange(300 if k % 2 else 32000) for _ in range(10)] for k in range(2000)]
    assert [model.decode(x) for x in ids] == sp.decode(ids)


def test_tokenize_rows(spark):
    long = "word " * 40_000
    rows = [(1, "a b", 9), (1, "a b", 9), (2, None, 9), (3, "", None), (None, "x", 9), (4, long, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    sp = SentencePieceProcessor(model_file=MODEL)
    got = sorted(((r.doc_id or 0, list(r.ids), r.decoded) for r in piece_tokens.tokenize(df, MODEL).collect()))
    want = sorted((i or 0, sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for i, t, _ in rows)
    assert got == want
    assert piece_tokens.tokenize(df.limit(0), MODEL).collect() == []


def test_fast_ids_equal_library():
    rng = random.Random(5)
    tokens = harmonic.Tokens(BYTES, RANKS, public_tokenizers.PATTERN)
    slow = Tokenizer.from_file(BYTES)
    chars = [chr(c) for c in range(1, 0x250)] + [" "] * 100 + ["<|endoftext|>", "梦", "'s", "12"]
    for _ in range(3000):
        text = "".join(rng.choices(chars, k=rng.randint(0, 12)))
        assert tokens(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_cuts_cover_and_fit():
    for n in range(0, 5000):
        pieces = harmonic.cuts(n)
        assert sum(length for length, _ in pieces) == n
        assert all(length * k <= harmonic.CAPACITY for length, k in pieces)


def test_packing_round_trip(spark):
    rng = random.Random(6)
    texts = ["w%d " % i * rng.randint(0, 900) for i in range(200)] + [None, "", "<|endoftext|>", "x" * 30_000]
    rows = [(i, t, "c") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(5)
    slow = Tokenizer.from_file(BYTES)
    got = harmonic.pack(df, BYTES, RANKS, public_tokenizers.PATTERN).collect()
    want = {i: [*slow.encode(t or "", add_special_tokens=False).ids, 1] for i, t, _ in rows}
    docs, sequences = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) and r.doc_tokens == len(want[r.doc_id])
        docs.setdefault(r.doc_id, []).append((r.start, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, ids in want.items():
        assert [x for _, part in sorted(docs[i]) for x in part] == ids
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        total += at
    assert padding < 0.01 * total


def test_packing_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    got = harmonic.pack(df, BYTES).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 2), (1, 2), (1, 2)]
    assert harmonic.pack(df.limit(0), BYTES).collect() == []
