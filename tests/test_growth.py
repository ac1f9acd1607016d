"""Trees grown as Spark aggregates, boosting over cells and exact tree Shapley values against
plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_models import auc, learnable
from txscore.operators import ensembles as N
from txscore.operators import explain as X
from txscore.operators import growth as G
from txscore.operators import samme as A
from txscore.operators import tree_shapley as T


def table(spark, x, y, fit=None):
    cols = [f"c{i}" for i in range(x.shape[1])]
    rows = [(i, int(b), 0 if fit is None else int(fit[i]), *map(float, a)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "tx_id long, label int, cv int, " + ", ".join(f"{c} double" for c in cols)), cols


def impurity(p, n, criterion):
    if not n:
        return 0.0
    if criterion == "gini":
        return -p * p / n
    return -n * sum(q * np.log2(q) for q in (p / n, 1 - p / n) if q > 0)


def plain_tree(bins, y, plan, depth=0):
    """A nested tuple (feature, bin, left, right) or (n, positives)."""
    n, p = len(y), int(y.sum())
    leaf = (float(n), float(p))
    if p in (0, n) or n < plan.min_split or depth == plan.max_depth:
        return leaf
    best = None
    for f in range(bins.shape[1]):
        for b in np.unique(bins[:, f])[:-1]:
            left = bins[:, f] <= b
            if min(left.sum(), n - left.sum()) < plan.min_leaf:
                continue
            gain = round(impurity(p, n, plan.criterion) - impurity(y[left].sum(), left.sum(), plan.criterion)
                         - impurity(y[~left].sum(), n - left.sum(), plan.criterion), 9)
            if best is None or gain > best[0]:
                best = (gain, f, int(b), left)
    if best is None or best[0] <= 1e-9:
        return leaf
    _, f, b, left = best
    return f, b, plain_tree(bins[left], y[left], plan, depth + 1), plain_tree(bins[~left], y[~left], plan, depth + 1)


def nested(nodes, at=0):
    if nodes["feature"][at] < 0:
        return nodes["n"][at], nodes["pos"][at]
    return (nodes["feature"][at], nodes["bin"][at], nested(nodes, nodes["left"][at]), nested(nodes, nodes["right"][at]))


def binned(x, cuts):
    return np.stack([np.where(np.isnan(x[:, i]), len(c), np.searchsorted(c, x[:, i])) for i, c in enumerate(cuts)], 1)


@pytest.mark.parametrize("plan", [G.Plan(criterion="entropy", max_depth=4), G.Plan(min_split=20, min_leaf=4),
                                  G.Plan(criterion="entropy")])
def test_grown_trees_equal_a_plain_one_in_every_fold(spark, plan):
    x, y = learnable(240)
    x = np.round(x, 1)
    fold = np.arange(len(x)) % 2
    rows, cols = table(spark, x, y, fold)
    cells, cuts = G.cell_table(rows, cols, "cv")
    grown = G.grow(cells, plan)
    for g in (0, 1):
        own = fold == g
        assert nested(grown[g]) == plain_tree(binned(x[own], cuts[g]), y[own], plan)


def test_forest_looks_at_its_features_and_random_cuts_differ(spark):
    x, y = learnable(400)
    rows, cols = table(spark, x, y)
    cells, cuts = G.cell_table(rows, cols)
    assert cells.agg(F.sum("n")).first()[0] == len(x) and cells.agg(F.sum("pos")).first()[0] == y.sum()
    plan = G.Plan(trees=30, features=2, min_split=5)
    one, again = G.grow(cells, plan)[0], G.grow(cells.repartition(3), plan)[0]
    assert all(np.array_equal(one[k], again[k]) for k in ("feature", "bin", "left", "n", "pos"))  # reproducible
    trees = N.from_nodes(one, cuts[0], 0, 30)
    assert len(trees.roots) == 30 and len(set(trees.feature[trees.roots].tolist())) > 1
    leaf = one["feature"] < 0
    assert np.bincount(one["tree"][leaf], one["n"][leaf]).tolist() == [len(x)] * 30
    part = N.from_nodes(one, cuts[0], 10, 20)  # a chunk is the same trees
    xt = learnable(50, 3)[0]
    whole = [N.from_nodes(one, cuts[0], i, i + 1).decision(xt) for i in range(10, 20)]
    assert np.allclose(part.decision(xt), sum(whole))
    random = G.grow(cells, G.Plan(criterion="entropy", random_cut=True, seed=1))[0]
    other = G.grow(cells, G.Plan(criterion="entropy", random_cut=True, seed=2))[0]
    assert random["bin"].tolist() != other["bin"].tolist()
    assert auc(N.from_nodes(random, cuts[0], 0, 1).decision(x), y) > 0.95


@pytest.mark.parametrize("plan", [G.Plan(trees=12, features=2, min_split=5), G.Plan(trees=3, criterion="entropy", min_leaf=3)])
def test_trees_grown_in_tasks_equal_those_of_counts(spark, monkeypatch, plan):
    x, y = learnable(300)
    rows, cols = table(spark, np.round(x, 1), y, np.arange(len(x)) % 2)
    cells, _ = G.cell_table(rows, cols, "cv")
    monkeypatch.setattr(G, "HELD_CELLS", 1)
    counted = G.grow(cells, plan)
    monkeypatch.undo()
    monkeypatch.setattr(G, "_count_cells", None)  # few cells: no shuffle of counts
    monkeypatch.setattr(G, "NODE_COUNTS", 256, raising=False)
    grown = G.grow(cells, plan)
    assert all(np.array_equal(grown[g][k], counted[g][k]) for g in (0, 1) for k in G.NODE)


def test_decision_equals_a_walk_and_scoring_deals_out_a_single_part(spark):
    x, y = learnable(300)
    x[::7, 1] = np.nan
    forest = N.fit_forest(x, y, 6, None, 2)
    stump = N.assemble([{"feature": np.array([1, -1, -1]), "cut": np.array([0.1, 0, 0]), "left": np.array([1, -1, -1]),
                         "right": np.array([2, -1, -1]), "value": np.array([0, 0.3, -0.7]), "gain": np.zeros(3)}], [0.9], 0.2)
    for m in (forest, stump):
        want = np.full(len(x), m.bias)
        for root, weight in zip(m.roots, m.weight, strict=True):
            for i, row in enumerate(x):
                at = root
                while m.feature[at] >= 0:
                    at = m.left[at] if row[m.feature[at]] <= m.cut[at] else m.right[at]
                want[i] += weight * m.value[at]
        assert np.array_equal(m.decision(x), want) and np.array_equal(N.Trees.from_bytes(m.to_bytes()).decision(x), want)
    rows, cols = table(spark, x, y)
    scored = N.score_table(rows.coalesce(1), {("RandomForest",): forest}, cols)
    assert scored.rdd.getNumPartitions() > 1 and scored.count() == len(x)


def test_growth_of_one_class_missing_values_and_empty_table(spark):
    x = np.full((20, 2), np.nan)
    rows, cols = table(spark, x, np.ones(20, int))
    cells, cuts = G.cell_table(rows, cols)
    nodes = G.grow(cells, G.Plan())[0]
    assert nodes["feature"].tolist() == [-1] and nodes["n"][0] == nodes["pos"][0] == 20
    assert G.grow(G.cell_table(rows.limit(0), cols)[0], G.Plan()) == {}


def plain_samme(x, y, rounds):
    """Row by row: the stump of the largest Gini gain, then new weights."""
    w, out = np.full(len(y), 1 / len(y)), []
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            for b in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= b
                gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left))
                gain = round(gain - (w * y).sum() ** 2 / w.sum(), 12)
                if best is None or gain > best[0]:
                    votes = [int((w[s] * y[s]).sum() > (w[s] * (1 - y[s])).sum()) for s in (left, ~left)]
                    best = (gain, f, int(b), *votes, left)
        _, f, b, vl, vr, left = best
        wrong = np.where(left, vl, vr) != y
        error = w[wrong].sum()
        if error >= 0.5 or error <= 0:
            break
        alpha = np.log((1 - error) / error)
        out.append((f, b, vl, vr, alpha))
        w = w * np.exp(alpha * wrong)
        w /= w.sum()
    return out


def test_samme_over_cells_equals_row_by_row(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, size=(200, 3))
    y = ((x[:, 0] + x[:, 1] > 3) ^ (rng.random(200) < 0.2)).astype(int)
    want = plain_samme(x, y, 12)
    rows = spark.createDataFrame([(list(map(int, a)), int(b)) for a, b in zip(x, y, strict=True)], "bins array<int>, y int")
    cells = rows.groupBy("bins").agg(F.count("*").cast("double").alias("n"), F.sum("y").cast("double").alias("pos"))
    got = A.rounds(cells, 12)
    assert len(got) == len(want) > 8  # past the cut of the lineage
    for r, (f, b, vl, vr, alpha) in zip(got, want, strict=True):
        assert (r["feature"], r["bin"], r["left"], r["right"]) == (f, b, vl, vr)
        assert r["alpha"] == pytest.approx(alpha)
    flat = cells.toPandas()
    bins = np.array(flat["bins"].tolist())
    w, label = np.concatenate([flat.pos, flat.n - flat.pos]), np.repeat([1, 0], len(flat))
    for (f, b, vl, vr, alpha), r in zip(want, A.fit_cells(np.concatenate([bins, bins]), label, w, 12), strict=True):
        assert r[:4] == (f, b, 2.0 * vl - 1, 2.0 * vr - 1) and r[4] == pytest.approx(alpha)


def test_samme_ends_at_no_error_and_at_chance(spark):
    bins, y = np.array([[0], [1]]), np.array([0, 1])
    assert A.fit_cells(bins, y, np.ones(2), 50) == [(0, 0, -1.0, 1.0, 1.0)]
    assert A.fit_cells(np.zeros((2, 1), int), y, np.ones(2), 50) == []
    cells = spark.createDataFrame([([0], 2.0, 0.0), ([1], 2.0, 2.0)], "bins array<int>, n double, pos double")
    assert [r["alpha"] for r in A.rounds(cells, 5)] == [1.0]
    alike = spark.createDataFrame([([0], 2.0, 1.0), ([1], 2.0, 1.0)], "bins array<int>, n double, pos double")
    assert A.rounds(alike, 5) == []


def test_weight_moves_the_first_boosting_step(spark):
    cells = spark.createDataFrame([([0], 10.0, 2.0), ([1], 10.0, 6.0)], "bins array<int>, n double, pos double")
    got = {r.weight: r for r in A.newton_splits(cells, [1, 4]).collect()}
    for weight in (1.0, 4.0):
        g, h = [(weight * p - (10 - p)) * 0.5 for p in (2, 6)], [(weight * p + 10 - p) * 0.25 for p in (2, 6)]
        r = got[weight]
        assert (r.g, r.h, r.feature, r.bin) == (sum(g), sum(h), 0, 0)
        assert r.leaf == pytest.approx(sum(g) / (sum(h) + 1))
        assert r.gain == pytest.approx(g[0] ** 2 / (h[0] + 1) + g[1] ** 2 / (h[1] + 1) - sum(g) ** 2 / (sum(h) + 1))


@pytest.mark.parametrize("family,params", [("XGBoost", {"n_estimators": 20}), ("RandomForest", {"n_estimators": 8}),
                                           ("DecisionTree", {}), ("AdaBoost", {"n_estimators": 40})])
def test_tree_shapley_equals_all_coalitions(spark, family, params):
    x, y = learnable(300)
    x = np.concatenate([x, learnable(300, 8)[0][:, :3]], axis=1)  # eight features, missing values too
    rows, cols = table(spark, x, y)
    model = N.load_models(N.fit_table(rows, cols, [family], {family: params}))[family,]
    background, some = x[:15], rows.where("tx_id >= 290")
    got = T.tree_shapley(some, background, cols, model).toPandas()
    wide = got.pivot(index="tx_id", columns="feature", values="phi")[cols].to_numpy()
    masks, w = X.exact_coalitions(len(cols))
    want = X.coalition_values(x[290:], background, masks, model.decision) @ w.T
    assert np.abs(wide - want).max() < 1e-9
    assert np.abs(wide.sum(1) - (model.decision(x[290:]) - model.decision(background).mean())).max() < 1e-9
    assert T.tree_shapley(rows.limit(0), background, cols, model).collect() == []
