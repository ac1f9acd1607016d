"""Spelling variants, source divergence and token counts against plain versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from txscore.llm import divergence, spelling, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LOWER = {c: c + 32 for c in range(65, 91)}


# --- spelling variants ----------------------------------------------------

def one_error(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


@pytest.mark.parametrize("cells,frontier", [(1 << 24, 1 << 20), (300, 200)])
def test_search_equals_brute_force(monkeypatch, cells, frontier):
    monkeypatch.setattr(spelling, "CELLS", cells)  # small: counts for every few places only
    monkeypatch.setattr(spelling, "FRONTIER", frontier)
    rng = random.Random(2)
    for letters in ("ab", "abcé", "abcdefÿ"):
        words = sorted({"".join(rng.choices(letters, k=rng.randint(6, 10))).encode("latin-1")
                        for _ in range(150)})
        n = np.array([rng.randint(5, 9) for _ in words])
        for side in (1, 0):
            near, best, best_n = spelling.near_words(words, n, words, side)
            for i, w in enumerate(words):
                h = len(w) // 2
                want = [j for j, x in enumerate(words) if one_error(w, x) and x.startswith(w[:h]) == bool(side)]
                top = min(want, key=lambda j: (-n[j], words[j]), default=-1)
                assert (near[i], best[i], best_n[i]) == (len(want), top, n[top] if want else 0)


def plain_variants(rows, damage=199):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [x for x in n if one_error(w, x)] for w in n}
    form = {}
    for w in n:
        top = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = top if top and n[top] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def variant_rows(seed=3):
    """Words in chains of misspellings, each five times as frequent as the one before."""
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdeéß", k=rng.randint(6, 9))) for _ in range(25)] + ["prefix" + c for c in "abcdefgh"]
    bag = []
    for stem in stems:
        at = rng.randrange(len(stem))
        wrong = stem[:at] + stem[at + 1:]
        bag += [stem.upper()] * 130 + [wrong] * 26 + ["x" + wrong] * 5 + [stem + "q"] * rng.randint(4, 7)
    rng.shuffle(bag)
    rows = [(i // 2, " ".join(bag[k:k + 40]) + "3 × Straße, ") for i, k in enumerate(range(0, len(bag), 40))]
    return rows + [(None, "nullid " * 9), (1, None), (2, ""), (3, "a" * 30_000 + " " + "b" * 30_000)] * 5


@pytest.mark.parametrize("shard_chars", [1 << 17, 300])
def test_variants_equal_brute_force(spark, shard_chars):
    rows = variant_rows()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = spelling.variants(df, shard_chars=shard_chars)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # chains of several forms


def test_variants_hot_prefix_ties_and_empty_table(spark):
    rng = random.Random(4)
    # one half in most words (a bucket in many parts), equal counts everywhere
    words = {"hothot" + "".join(rng.choices("abc", k=3)) for _ in range(40)} | {"abcdef", "abcdeg"}
    rows = [(i, " ".join(sorted(words))) for i in range(5)] + [(9, "abcdeh " * 25 + "abcdei " * 25)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, spelling.variants(df, damage=0, shard_chars=60).collect()))
    assert got == plain_variants(rows, 0)
    assert spelling.variants(df.limit(0)).collect() == []
    assert spelling.variants(df.withColumn("text", df.text.substr(1, 2))).collect() == []


# --- source divergence ----------------------------------------------------

def test_transducer():
    rng = random.Random(1)
    for _ in range(60):
        words = sorted({bytes(rng.choices(b"abc\xc3", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 150))})
        t = divergence.Transducer.loads(divergence.Transducer.build(words).dumps())
        assert list(t.terms()) == words
        asked = words + [bytes(rng.choices(b"abcd", k=rng.randint(0, 7))) for _ in range(50)]
        assert t.ordinals(asked).tolist() == [words.index(w) if w in words else -1 for w in asked]
    # minimal: words with the same ends share their states
    ends = divergence.Transducer.build(sorted(a + b for a in (b"a", b"b", b"c") for b in (b"xyz", b"xz")))
    assert len(ends.final) == 5


def plain_audit(rows):
    docs = [(lang or "", source or "", [w.translate(LOWER) for w in re.findall(
        "[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(w for d in docs if d[0] == lang for w in set(d[2]))
        kept = [w for w in df if df[w] >= 3]
        sources = {d[1] for d in docs if d[0] == lang}
        count = {s: Counter(w for d in docs if d[:2] == (lang, s) for w in d[2] if df[w] >= 3) for s in sources}
        count[None] = sum(count.values(), Counter())
        p = {s: {w: 1 + 10 ** 9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
             for s, c in count.items()}
        for s in sources:
            def f(w, q, s=s):
                return (p[s][w] - p[q][w]) ** 2 // p[q][w]
            pair = [(-sum(f(w, q) for w in kept), q.encode(), "pair", q) for q in sources - {s}]
            term = [(-f(w, None), w.encode(), "term", w) for w in kept if count[s][w] and p[s][w] > p[None][w]]
            for part, top in ((pair, None), (term, 200)):
                out += [(lang, s, kind, item, -v, i) for i, (v, _, kind, item) in enumerate(sorted(part)[:top], 1)]
    return sorted(out)


def audit_rows():
    rng = random.Random(5)
    pool = [a + b for a in ("Wort", "élan", "梦", "x") for b in "abcdefghijklmnopqrstuvwxyz"]
    rows = []
    for i in range(120):
        s = rng.choices(["hot", "s1", "s2", "é", None], [8, 2, 2, 1, 1])[0]
        rows.append((rng.choice(["en", "en", "de", None]), s, ", ".join(rng.choices(pool[:20 + i], k=rng.randint(0, 80)))))
    rows += [("en", "hot", "many same rows")] * 7 + [("fr", "only", "un deux")] + [("pt", s, None) for s in "ab"]
    return rows + [("de", "s1", "very long " * 20_000), ("de", "s1", "q" * 50_000), ("en", "ties", "wa wb wc")] * 3


@pytest.mark.parametrize("shard_terms,max_broadcast", [(1 << 17, 64 << 20), (7, 64 << 20), (7, 0)])
def test_audit_equals_plain_version(spark, shard_terms, max_broadcast):
    rows = audit_rows()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                               "lang string, source string, text string, term string, n int")
    got = divergence.audit(df, shard_terms=shard_terms, max_broadcast=max_broadcast)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                          ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows)


def test_audit_empty_table_and_no_terms(spark):
    df = spark.createDataFrame([("en", "a", "one"), ("en", "b", None)], "lang string, source string, text string")
    assert divergence.audit(df.limit(0)).collect() == []
    assert sorted(map(tuple, divergence.audit(df).collect())) == [
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


# --- token counts ---------------------------------------------------------

def token_rows():
    rng = random.Random(1)
    pool = list(" \n▁ab1é梦😀\ttheing—ñß<>²½_.,") + [" "] * 8 + ["the", "ing", "  ", "----", "▁▁"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 3000))) for _ in range(60)]
    texts += [None, "", " " * 5000, "a" * 9000, "-" * 7000, "ab" * 4000, "word " * 3000, "\n" * 3000, "梦" * 3000,
              "😀" * 2000, "▁" * 4000, "the" * 3000, "</s><unk>" * 500]
    return list(enumerate(texts)) + [(None, "x y" * 2000), (5, "x y" * 2000), (5, "x y" * 2000)]


@pytest.mark.parametrize("chunk,overlap", [(400, 50), (200, 4), (1 << 16, 256)])
def test_token_counts_equal_library(spark, chunk, overlap):
    rows = token_rows()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, key int, part string")
    got = token_counts.token_counts(df, MODEL, chunk=chunk, overlap=overlap, limit=600)
    sp = SentencePieceProcessor(model_file=MODEL)
    want = sorted((-1 if i is None else i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 600) for i, t in rows)
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got.collect()) == want


def test_seams_of_equal_characters_fail_and_are_joined():
    # chunks in different steps of a row of letters share no token
    pieces = token_counts.Pieces(MODEL)
    a, b = (pieces.encode("ab" * n) for n in (1001, 1000))
    near = token_counts.near_seam(*a, 0, 10**6, 0, 0)
    assert token_counts.drop_at_seam(near, near, len(a[0])) == len(a[0])
    assert token_counts.drop_at_seam(near, np.zeros(1, np.int64).tobytes(), len(a[0])) is None
    assert b[1][-1] == 2000


def test_token_counts_empty_table(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert token_counts.token_counts(df.limit(0), MODEL).collect() == []
    with pytest.raises(ValueError):
        token_counts.token_counts(df, MODEL, chunk=10, overlap=5)
    with pytest.raises(ValueError):
        token_counts.token_counts(df.drop("text"), MODEL)
