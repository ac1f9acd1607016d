"""Suffix-array removal of repeats against brute force over all windows."""

import random

import numpy as np
import pytest

from txscore.llm import repeats

SCHEMA = "doc_id long, text string, lo string, h string, spans string"


def brute(texts, least):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for d, b in enumerate(data):
        for i in range(len(b) - least + 1):
            seen.setdefault(b[i:i + least], []).append((d, i))
    gone = [bytearray(len(b)) for b in data]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + least] = b"\1" * least
    out = []
    for b, g in zip(data, gone, strict=True):
        kept = bytes(x for x, m in zip(b, g, strict=True) if not m)
        runs = sum(1 for i, m in enumerate(g) if m and (not i or not g[i - 1]))
        out.append((len(b), sum(g), runs, kept))
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA).repartition(3)
    got = repeats.remove_repeats(df, **options).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes,
                   sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in got)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghé ") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    passages = [" ".join(rng.choices(words, k=60)) for _ in range(4)]
    out = []
    for _ in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(0, 150)))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            i, j = sorted(rng.randrange(len(p)) for _ in range(2))
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice([p, p[i:j], p[:j], p[i:]]) + text[at:]
        out.append(text)
    near = out[3] + " ".join(rng.choices(words, k=90))
    out += [near, near[:150] + "!" + near[151:], near[:340] + near[345:], near]
    out += ["a" * 500, "a" * 201, "b" + "a" * 200, "ab" * 230, "xyz" * 90 + "q" + "xyz" * 80, "", None]
    return out


@pytest.mark.parametrize("options", [{}, {"min_bytes": 60, "gram": 16}, {"hot_classes": 2},
                                     {"min_bytes": 30, "gram": 30}])
def test_equals_brute_force(spark, options):
    texts = corpus(len(str(options)))
    want = sorted((i, *w) for i, w in enumerate(brute(texts, options.get("min_bytes", 200))))
    got = run(spark, list(enumerate(texts)), **options)
    assert got == want
    assert any(w[2] for w in want)


@pytest.mark.parametrize("known", [1 << 17, 40])
def test_a_passage_and_copies_in_most_rows(spark, monkeypatch, known):
    monkeypatch.setattr(repeats, "KNOWN_CONTENTS", known)
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    own = lambda n: " ".join(word() for _ in range(n))
    passage, copy = own(70), own(120)
    texts = [own(rng.randint(0, 40)) + passage + own(rng.randint(0, 40)) for _ in range(150)]
    texts += [copy] * 150 + [copy + own(20)] * 20 + [own(60) for _ in range(40)]
    rows = list(enumerate(texts))
    want = sorted((i, *w) for i, w in enumerate(brute(texts, 200)))
    for hot in (20, 20_000):
        assert run(spark, rows, hot_classes=hot) == want
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeats.fragments(repeats._keyed(df, "doc_id", "text"), 200, 48).where("not direct")
    rows_of = found.groupBy("h", "c").count().agg({"count": "max"}).collect()[0][0]
    if known > 1000:
        assert rows_of <= 2 * 3  # two for each task, however many copies


def test_settled_ranges_cover_what_they_replace():
    rng = np.random.default_rng(1)
    known, seen, before = np.zeros(0, np.int64), [], set()
    for _ in range(20):
        m = 200
        row = np.sort(rng.integers(0, 10, m))
        lo = rng.integers(0, 3000, m).astype(np.int32)
        c, n = rng.integers(0, 60, m), np.full(m, 200, np.int32)
        flags = np.zeros(m, bool)
        out, known = repeats.settle([c * 7, c, row, row * 31, lo, n, n * 0, flags, flags], row, known)
        _, oc, oid, _, olo, on, _, omulti, odirect = out
        for k in range(m):  # every fragment is there, or inside a range of its row
            inside = (oid == row[k]) & (olo <= lo[k]) & (olo + on >= lo[k] + n[k])
            assert (inside & (odirect | (oc == c[k]))).any()
        assert omulti[odirect].all()
        handed, times = np.unique(oc[~odirect], return_counts=True)
        assert times.max(initial=0) <= 2 and before.isdisjoint(handed.tolist())
        before |= set(handed[times == 2].tolist())
        seen.append(len(oc))
    assert seen[-1] < seen[0]


def test_steps_do_not_matter():
    text = ("".join(random.Random(5).choices("abcd", k=3000)) * 2).encode()
    for step in (1 << 20, 500, 37):
        cut = list(repeats.Anchors(50, 20, step).cut(text))
        windows = [w for _, lo, n, _ in cut for i, m in zip(lo, n, strict=True) for w in range(i, i + m - 49)]
        assert windows == list(range(len(text) - 49))


def test_repeated_rows_null_ids_and_ties(spark):
    long = "".join(random.Random(1).choices("abcdefgh ", k=400))
    rows = [(1, long), (1, long), (None, long[:250]), (None, None), (2, "short"), (2, ""), (3, long + "tail")]
    got = run(spark, rows)
    assert [g[0] for g in got] == [-1, -1, 1, 1, 2, 2, 3]
    assert [g[2] for g in got] == [0, 250, 400, 400, 0, 0, 400]
    assert got[-1][-1] == b"tail"


def test_empty_table(spark):
    assert run(spark, []) == []


def test_maximal_repeats_list_all_occurrences():
    texts = [b"..KEYabcd", b"xyKEYabcd", b"xyKEYabzz", b"qqKEYabcq"]
    before, after = [t[:2][::-1] for t in texts], [t[2:] for t in texts]
    found = {(left, right, tuple(sorted(m))) for left, right, m in
             repeats.maximal_repeats(before, after, 5)}
    assert found == {(0, 7, (0, 1)), (0, 6, (0, 1, 3)), (0, 5, (0, 1, 2, 3)), (2, 5, (1, 2))}
