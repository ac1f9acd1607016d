"""SimHash with BK-trees and the vector forest against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from txscore.llm import bk_simhash, rp_forest
from txscore.llm.components import components


def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    comp = list(range(n))
    while True:
        new = [min([comp[i], *(comp[j] for j in linked[i])]) for i in range(n)]
        if new == comp:
            return comp
        comp = new


def test_fingerprint_is_that_of_the_definition():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 400):
        text = " ".join(rng.choices(["Aa", "b\t", "É", "c\n\nd", "x" * 30], k=n))
        assert bk_simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_forest_links_all_near_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (30, 40, 4), dtype=np.uint64), axis=2)
    values = np.unique(np.concatenate([base, (base[:, None] ^ flips).ravel()]))
    shard = rng.integers(0, 3, len(values))
    near = (np.bitwise_count(values[:, None] ^ values) <= radius) & (shard[:, None] == shard)
    want = np.arange(len(values))
    bk_simhash.unite(want, *np.nonzero(near))
    a, b = bk_simhash.shard_links(values, shard, np.zeros(len(values), int), radius)
    got = np.arange(len(values))
    bk_simhash.unite(got, np.searchsorted(values, a), np.searchsorted(values, b))
    assert (bk_simhash.find(got, np.arange(len(got))) == bk_simhash.find(want, np.arange(len(want)))).all()


def corpus():
    rng = random.Random(2)
    words = ["w%d" % i for i in range(300)]
    texts = []
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(40, 250))
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return texts + ["", None, " \n", "one", "ONE", "two words", texts[0], texts[0].upper()]


@pytest.mark.parametrize("limit", [50_000, 3])
def test_near_duplicates_equal_brute_force(spark, limit):
    texts = corpus()
    order = list(range(len(texts)))
    random.Random(7).shuffle(order)
    rows = [(i, texts[k], "x", "y") for i, k in enumerate(order)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id string").repartition(4)
    fps = [slow_fingerprint(r[1]) for r in rows]
    linked = [[j for j, g in enumerate(fps) if (f ^ g).bit_count() <= 3] for f in fps]
    comp = groups(len(rows), linked)
    got = bk_simhash.near_duplicates(df, shard_limit=limit).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == [
        (i, f"{fps[i]:016x}", comp[i]) for i in range(len(rows))]
    kept = bk_simhash.keep_one(df, shard_limit=limit)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(comp))


def test_simhash_repeated_rows_null_ids_empty_table(spark):
    a, b = "alpha beta gamma delta", "other words of another text entirely here"
    rows = [(5, a), (5, a), (None, a), (7, a), (None, b), (None, b), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bk_simhash.near_duplicates(df).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got if r.component_id is not None) == [
        (-1, 5), (5, 5), (5, 5), (7, 5), (9, 9)]
    assert sum(r.component_id is None for r in got) == 2
    kept = sorted((r.doc_id or -1, r.text) for r in bk_simhash.keep_one(df).collect())
    assert [k[0] for k in kept] == [-1, 5, 9]
    assert bk_simhash.near_duplicates(df.limit(0)).collect() == []
    assert bk_simhash.keep_one(df.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(300, 300), (None, 1)]
    links += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df, "a", "b").collect()}
    parent = list(range(500))
    pairs = [(a, b) for a, b in links if a is not None and a != b]
    want = groups(500, [[b for a, b in pairs if a == i] + [a for a, b in pairs if b == i] for i in parent])
    assert got == {i: want[i] for i in {x for p in pairs for x in p}}


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(80, 16))
    out = [b + rng.normal(size=16) * rng.choice([0, .05, .2, .3]) for b in base for _ in range(rng.integers(1, 9))]
    hub = rng.normal(size=16)
    out += [hub + rng.normal(size=16) * .02 for _ in range(120)] + [hub] * 40
    return [list(map(float, v)) for v in out]


@pytest.mark.parametrize("options", [{}, {"leaf_size": 20}, {"leaf_size": 20, "leaf_limit": 30}])
def test_vector_links_equal_brute_force(spark, options):
    x = vectors()
    odd = [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] + [1.0] * 15,
           [1.0, 2.0], [2.0, 4.0], [1e-300] * 16, [1e300] * 16]
    rows = [(3 * i, v, "x", "y") for i, v in enumerate(x + odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string, rep string").repartition(4)
    n = len(rows)
    linked = [[] for _ in range(n)]
    unit = []
    for _, v, *_ in rows:
        ok = v and all(c is not None and np.isfinite(c) for c in v) and any(v)
        a = np.array(v) / np.abs(v).max() if ok else None
        unit.append(a / np.linalg.norm(a) if ok else None)
    for i in range(n):
        for j in range(n):
            if i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]):
                if unit[i] @ unit[j] >= 0.95:
                    linked[i].append(j)
    comp = groups(n, linked)
    got = {r.vec_id: r for r in rp_forest.near_duplicates(df, **options).collect()}
    assert len(got) == n
    true = sum(map(len, linked))
    found = sum(r.n_links for r in got.values())
    assert all(got[3 * i].n_links <= len(linked[i]) for i in range(n))  # no link twice, none below
    assert found >= (0.98 if options else 0.999) * true
    assert sum(got[3 * i].component_id == 3 * comp[i] for i in range(n)) >= 0.98 * n
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_vectors_repeated_rows_null_ids_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in rp_forest.near_duplicates(df).collect())
    assert got == [(0, 0, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert rp_forest.near_duplicates(df.limit(0)).collect() == []
