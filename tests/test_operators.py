"""Invariants and brute-force checks of the custom DataFrame operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txscore.operators import neighbors as NB
from txscore.operators import prep as P
from txscore.operators.ordered import ordered_prefix, ordered_row_number
from txscore.operators.smote import smote, synthetic_count
from txscore.operators import stats as ST


def _vectors(spark, n, d, seed, dup=0):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(d)], int(rnd.random() < 0.3)) for i in range(n)]
    for j in range(dup):  # exact duplicates and a heavy cluster of equal projections
        rows.append((n + j, list(rows[0][1]), 1))
    return spark.createDataFrame(rows, "id long, vec array<double>, label int"), rows


def _brute(q_rows, r_rows, k, metric, exclude_self):
    out = {}
    for qi, qv, _ in q_rows:
        ds = []
        for ri, rv, _ in r_rows:
            if exclude_self and qi == ri:
                continue
            if metric == "l1":
                d = 0.0
                for a, b in zip(qv, rv):
                    d += abs(a - b)
            else:
                s = 0.0
                for a, b in zip(qv, rv):
                    s += (a - b) * (a - b)
                d = math.sqrt(s)
            ds.append((d, ri))
        out[qi] = [ri for _, ri in sorted(ds)[:k]]
    return out


def test_knn_join_is_exact(spark, monkeypatch):
    monkeypatch.setattr(NB, "TARGET_BAND_ROWS", 16)   # many bands on a small table
    df, rows = _vectors(spark, 300, 6, 1, dup=20)
    for metric in ("l1", "l2"):
        got = {}
        for r in NB.knn_join(df, df, 4, metric=metric, exclude_self=True).collect():
            got.setdefault(r["q_id"], []).append((r["rank"], r["r_id"]))
        want = _brute(rows, rows, 4, metric, True)
        assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == want


def test_knn_join_hot_band_is_exact(spark, monkeypatch):
    """A third of the references share one vector: the hot band is sliced."""
    monkeypatch.setattr(NB, "TARGET_BAND_ROWS", 8)
    df, rows = _vectors(spark, 120, 5, 7, dup=60)
    got = {}
    for r in NB.knn_join(df, df, 3, metric="l1", exclude_self=True).collect():
        got.setdefault(r["q_id"], []).append((r["rank"], r["r_id"]))
    want = _brute(rows, rows, 3, "l1", True)
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == want


def test_knn_join_grouped(spark, monkeypatch):
    """Groups are independent problems (e.g. folds) solved in one job."""
    monkeypatch.setattr(NB, "TARGET_BAND_ROWS", 16)
    df, rows = _vectors(spark, 150, 4, 9)
    g = df.withColumn("g", (F.col("id") % 3).cast("int"))
    got = {}
    for r in NB.knn_join(g, g, 2, metric="l2", exclude_self=True, group="g").collect():
        got.setdefault((r["g"], r["q_id"]), []).append((r["rank"], r["r_id"]))
    for grp in range(3):
        sub = [r for r in rows if r[0] % 3 == grp]
        want = _brute(sub, sub, 2, "l2", True)
        assert {q: [i for _, i in sorted(v)] for (gg, q), v in got.items() if gg == grp} == want


def test_knn_classify_weights(spark):
    nn = spark.createDataFrame([(1, 10, 0.5, 1), (1, 11, 1.0, 2), (2, 10, 0.0, 1), (2, 12, 2.0, 2)],
                               "q_id long, r_id long, dist double, rank int")
    labels = spark.createDataFrame([(10, 1), (11, 0), (12, 0)], "id long, label int")
    got = {r["q_id"]: (r["score"], r["pred"]) for r in NB.knn_classify(nn, labels).collect()}
    assert abs(got[1][0] - 2.0 / 3.0) < 1e-12 and got[1][1] == 1
    assert got[2] == (1.0, 1)   # a zero-distance neighbour takes all weight


def test_smote_invariants(spark):
    df, rows = _vectors(spark, 200, 4, 2)
    n_min = sum(1 for r in rows if r[2] == 1)
    n_maj = len(rows) - n_min
    out = smote(df, ratio=0.9, k=3, metric="l2")
    synth = out.where("is_synthetic").collect()
    assert len(synth) == synthetic_count(n_maj, n_min, 0.9)
    vec = {r[0]: r[1] for r in rows}
    for s in synth:
        x, y, u = np.array(vec[s["base_id"]]), np.array(vec[s["neighbor_id"]]), s["gap"]
        assert 0.0 <= u < 1.0
        assert np.allclose(np.array(s["vec"]), x + u * (y - x), atol=1e-12)
    assert out.where(~F.col("is_synthetic")).count() == len(rows)


def test_ordered_prefix_matches_window(spark):
    rnd = random.Random(3)
    rows = [(g, i, rnd.randint(0, 5)) for g in ("a", "b", "c") for i in range(500)]
    rows += [("hot", i, 1) for i in range(3000)]   # one group holds most rows
    df = spark.createDataFrame(rows, "g string, o int, v int")
    got = {(r["g"], r["o"]): (r["cum_v"], r["idx"])
           for r in ordered_prefix(df, ["g"], [F.col("o").desc()], ["v"]).collect()}
    for g in ("a", "b", "c", "hot"):
        seq = sorted((r for r in rows if r[0] == g), key=lambda r: -r[1])
        c = 0
        for i, r in enumerate(seq, 1):
            c += r[2]
            assert got[(g, r[1])] == (c, i)


def test_exact_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(4)
    vals = np.concatenate([rnd.normal(size=997), [1.0] * 300])
    df = spark.createDataFrame([("f", float(v)) for v in vals], "feature string, value double")
    got = {r["p"]: r["q"] for r in P.exact_quantiles(df, [0.25, 0.5, 0.75, 0.9]).collect()}
    for p in (0.25, 0.5, 0.75, 0.9):
        assert abs(got[p] - np.percentile(vals, p * 100)) < 1e-12


def test_shapiro_invariants(spark):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=40)
    rows = [("a", float(v)) for v in x] + [("b", float(3 * v + 7)) for v in x] + \
           [("u", float(v)) for v in rnd.uniform(size=200) ** 4]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in ST.shapiro_wilk(df, ["g"], "v").collect()}
    assert 0 < got["a"]["w"] <= 1 and abs(got["a"]["w"] - got["b"]["w"]) < 1e-12   # shift/scale invariant
    assert got["a"]["p_value"] > 0.05 and got["u"]["p_value"] < 1e-6


def test_split_cutoff_refinement_matches_ranking(spark, monkeypatch):
    """Several refinement passes (tiny fetch limit) give the rank-based split."""
    import hashlib
    from txscore.operators import sampling as SM
    monkeypatch.setattr(SM, "CUTOFF_COLLECT_MAX", 3)
    monkeypatch.setattr(SM, "HEX_STEP", 1)
    rows = [(i, int(i % 7 == 0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "tx_id long, label int")
    got = {r["tx_id"]: r["part"] for r in SM.stratified_split(df).collect()}
    for lab in (0, 1):
        ids = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i, y in rows if y == lab)
        k = int(0.25 * len(ids) + 0.5)
        assert {i for _, i in ids[:k]} == {i for _, i in ids if got[i] == "test"}


def test_sampled_shapley_efficiency_and_exact_limit(spark):
    """Permutation sampling keeps sum(phi) = f(x) - E_b f(b); with all d!
    orders it equals the exact values."""
    from itertools import permutations
    from txscore.operators import explain as X
    rnd = random.Random(11)
    rows = [(i, rnd.uniform(0, 5), rnd.uniform(0, 5), rnd.uniform(0, 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "tx_id long, a double, b double, c double")
    bg = df.where("tx_id < 6")
    f = lambda x: x[:, 0] * x[:, 1] + np.sin(x[:, 2]) * x[:, 0]
    feats = ["a", "b", "c"]
    exact = {(r["tx_id"], r["feature"]): r["phi"] for r in X.shapley_exact(df, bg, feats, f).collect()}
    orders = X.sampled_coalitions(3, X.sampled_permutations(3, 4))
    sampled = {(r["tx_id"], r["feature"]): r["phi"]
               for r in X.shapley_values(df, bg, feats, f, orders).collect()}
    fx = {r[0]: r[1] * r[2] + math.sin(r[3]) * r[1] for r in rows}
    ef = sum(fx[i] for i in range(6)) / 6
    for i in fx:
        assert abs(sum(sampled[(i, g)] for g in feats) - (fx[i] - ef)) < 1e-9
        assert abs(sum(exact[(i, g)] for g in feats) - (fx[i] - ef)) < 1e-9
    # over all d! orders the sampled weights are the exact ones
    masks, w = X.sampled_coalitions(3, [list(p) for p in permutations(range(3))])
    all_masks, exact_w = X.exact_coalitions(3)
    at = {m.tobytes(): i for i, m in enumerate(all_masks)}
    assert np.allclose(w, exact_w[:, [at[m.tobytes()] for m in masks]])


def test_sixty_features_within_the_budget(spark):
    """200 evaluations explain a record of 60 features: at most 200 coalitions, and exact for a
    linear model."""
    from txscore.operators import explain as X
    d, rng = 60, np.random.default_rng(1)
    masks, w = X.budgeted_coalitions(d, 200)
    assert len(masks) <= 200 and w.shape == (d, len(masks))
    coef, x, bg = rng.normal(size=d), rng.normal(size=(5, d)), rng.normal(size=(50, d))
    cols = [f"c{i}" for i in range(d)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                               "tx_id long, " + ", ".join(f"{c} double" for c in cols))
    got = X.shapley_values(df, bg, cols, lambda z: z @ coef, (masks, w)).collect()
    want = coef * (x - bg.mean(0))
    assert all(abs(r.phi - want[r.tx_id, int(r.feature[1:])]) < 1e-9 for r in got) and len(got) == 5 * d


def test_shapley_takes_a_fitted_model_and_checks_the_background(spark):
    from txscore.operators import explain as X
    from txscore.operators.bayes import GaussianNBModel
    df = spark.createDataFrame([(i, float(i % 7), float(i % 5), int(i % 7 > 4)) for i in range(60)],
                               "tx_id long, a double, b double, label int")
    model = GaussianNBModel.fit(df, ["a", "b"])
    scores = {r.tx_id: r.score for r in model.transform(df).collect()}
    x = np.array([[r.a, r.b] for r in df.orderBy("tx_id").collect()])
    assert np.allclose(model.predictor()(x), [scores[i] for i in range(60)])
    phi = {}
    for r in X.shapley_exact(df, df.limit(9), ["a", "b"], model.predictor()).collect():
        phi[r.tx_id] = phi.get(r.tx_id, 0) + r.phi
    mean = model.predictor()(X.background_matrix(df.limit(9), ["a", "b"])).mean()
    assert all(abs(phi[i] - (scores[i] - mean)) < 1e-9 for i in phi)
    old, X.BACKGROUND_BYTES = X.BACKGROUND_BYTES, 100
    try:
        with pytest.raises(ValueError, match="take a sample"):
            X.background_matrix(df, ["a", "b"])
    finally:
        X.BACKGROUND_BYTES = old


def test_numeric_summary_imputed_quartiles_match_numpy(spark):
    """Median of the raw values and quartiles of the median-imputed column,
    from one cumulative table, equal numpy on the materialised imputed column."""
    rnd = np.random.default_rng(12)
    a = [float(v) for v in rnd.integers(0, 30, size=400)]          # many ties
    b = [float(v) for v in rnd.normal(size=400)]
    rows = [(i, a[i] if i % 5 else None, b[i] if i % 3 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = P.numeric_summary(df, ["a", "b"])
    for c, vals in (("a", [r[1] for r in rows]), ("b", [r[2] for r in rows])):
        raw = np.array([v for v in vals if v is not None])
        med = float(np.percentile(raw, 50))
        imp = np.array([med if v is None else v for v in vals])
        assert abs(got[c]["median"] - med) < 1e-12
        assert abs(got[c]["q25"] - np.percentile(imp, 25)) < 1e-12
        assert abs(got[c]["q75"] - np.percentile(imp, 75)) < 1e-12


def test_knn_boxes_prune_vectors_of_equal_sums(spark):
    """All sums are zero, and some vectors are null or hold values at no finite distance."""
    rng = np.random.default_rng(5)
    u = rng.random((2400, 2)) * 100
    x = np.stack([u[:, 0], -u[:, 0], u[:, 1], -u[:, 1]], axis=1)
    schema = "id long, vec array<double>"
    refs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], schema)
    asked = spark.createDataFrame([(10_000 + i, (v + 0.5).tolist()) for i, v in enumerate(x[::20])], schema)
    assert NB.candidate_share(asked, refs, 3) < 0.35
    odd = spark.createDataFrame([(5000, None), (5001, [float("nan")] * 4), (5002, [None, 1.0, 1.0, 1.0]),
                                 (5003, [float("inf")] * 4)], schema)
    for metric in ("l1", "l2"):
        got = NB.knn_join(asked.unionByName(odd), refs.unionByName(odd), 3, metric=metric).collect()
        diff = x[::20][:, None, :] + 0.5 - x[None]
        d = np.abs(diff).sum(2) if metric == "l1" else np.sqrt((diff ** 2).sum(2))
        near = np.argsort(d, axis=1, kind="stable")[:, :3]
        assert {(r.q_id, r["rank"], r.r_id) for r in got} == {
            (10_000 + i, j + 1, int(r)) for i, own in enumerate(near) for j, r in enumerate(own)}
