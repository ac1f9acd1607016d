"""Fits over all rows in tasks of their own, against the fits of small tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from test_models import auc, learnable
from txscore.operators import ensembles as N
from txscore.operators import growth as G
from txscore.operators import samme as A
from txscore.operators import whole as W


def table(spark, x, y, **more):
    cols = [f"c{i}" for i in range(x.shape[1])]
    rows = [(i, int(b), *(int(v[i]) for v in more.values()), *map(float, a)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    schema = ", ".join(["tx_id long, label int", *(f"{c} int" for c in more), *(f"{c} double" for c in cols)])
    return spark.createDataFrame(rows, schema), cols


def spooled(bins, y, asked=()):
    """Rows of a fit in batches of 100, and the numbers of the rows in their order."""
    kind = np.where(y == 1, W.POSITIVE, W.OTHER)
    kind[list(asked)] = W.ASKED
    order = np.argsort(kind, kind="stable")
    batches = [pa.RecordBatch.from_arrays([pa.array(kind[o].astype(np.int32)), pa.array(
        [bytes(b) for b in bins[o].astype(np.uint8)], pa.binary())], ["kind", "bins"])
        for o in np.array_split(order, max(1, len(order) // 100))]
    return W.Rows(batches, bins.shape[1]), order


@pytest.fixture(params=[(1 << 16, 1 << 13), (64, 3)])
def sizes(request, monkeypatch):
    """One block, or many and few open nodes at a time."""
    monkeypatch.setattr(W, "BLOCK", request.param[0])
    monkeypatch.setattr(W, "OPEN_NODES", request.param[1])


def test_boosting_equals_that_in_memory(sizes):
    x, y = learnable(700)
    bins, cuts = N.bin_features(x)
    asked = range(600, 700)
    rows, order = spooled(bins, y, asked)
    own = order[:600]
    p = N.TUNED["XGBoost"] | {"n_estimators": 30, "subsample": 1.1}
    grower = N.Grower(x[own])
    grower.binned, grower.cuts = bins[own], cuts
    grower.open = np.array([[b < len(c) for b in range(N.BINS)] for c in cuts])
    grower.edges = np.array([[c[b] if b < len(c) else np.nan for b in range(N.BINS)] for c in cuts])
    margin = rows.scratch()
    want, w = np.zeros(600), np.where(y[own] == 1, 4, 1.0)
    for t in W.boost(rows, cuts, **p, margin=margin, rngs=N.seeds(30, 42)):
        q = 1 / (1 + np.exp(-want))
        old = grower.tree(w * (y[own] - q), w * q * (1 - q), np.arange(600), 15, 1.0, 1.0, 1)
        want += 0.05 * old["value"][N.leaves(old["feature"], old["bin"], old["left"], old["right"], grower.binned)]
        assert len(t["value"]) == len(old["value"]) and np.array_equal(t["feature"], old["feature"])
        assert np.allclose(t["value"], old["value"]) and np.allclose(margin[:600], want)
        assert np.allclose(t["cut"], old["cut"])
    whole = N.assemble([t for t in W.boost(rows, cuts, **p, margin=rows.scratch(), rngs=N.seeds(30, 42))], [0.05] * 30)
    assert np.allclose(whole.decision(x)[order], margin)  # the rows that are only scored, too


@pytest.mark.parametrize("plan", [G.Plan(criterion="entropy", min_leaf=3), G.Plan(min_split=5), G.Plan(max_depth=3)])
def test_a_tree_equals_that_of_the_counts(spark, sizes, plan):
    x, y = learnable(600)
    rows, cols = table(spark, np.round(x, 1), y)
    cells, cuts = G.cell_table(rows, cols)
    old = N.from_nodes(G.grow(cells, plan)[0], cuts[0], 0, 1)
    bins = np.column_stack([np.where(np.isnan(v), len(c), np.searchsorted(c, v)) for v, c in zip(np.round(x, 1).T, cuts[0], strict=True)])
    spool, order = spooled(bins, y, [])
    score = spool.scratch()
    t = W.grow_tree(spool, cuts[0], plan, np.random.default_rng(0), score)
    new = N.assemble([t], [1.0])
    assert len(new.value) == len(old.value) and np.array_equal(new.decision(np.round(x, 1)), old.decision(np.round(x, 1)))
    assert np.array_equal(score, old.decision(np.round(x, 1))[order])


def test_a_random_cut_and_a_subset_of_features_split_all_rows(sizes):
    x, y = learnable(900)
    bins, cuts = N.bin_features(x)
    spool, order = spooled(bins, y, range(800, 900))
    for plan in (G.Plan(random_cut=True), G.Plan(features=2)):
        score = spool.scratch()
        t = W.grow_tree(spool, cuts, plan, np.random.default_rng(1), score)
        tree = N.assemble([t], [1.0])
        assert np.allclose(score, tree.decision(x)[order])
        leaf = tree.decision(x[:800])
        assert np.mean((leaf > 0.5) == y[:800]) > 0.97 and (t["feature"] >= 0).sum() * 2 + 1 == len(t["feature"])


def test_stumps_equal_those_of_cells(sizes):
    x, y = learnable(500)
    bins, cuts = N.bin_features(x)
    spool, order = spooled(bins, y, [])
    want = A.fit_cells(bins[order], y[order], np.ones(500), 60)
    got = W.boost_stumps(spool, 60)
    assert len(got) == len(want) > 20 and [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want])
    share = np.array([g[4] for g in got])
    model = N.assemble(A.stumps(got, cuts), share)
    assert np.allclose(W.stump_scores(spool, got, share), model.decision(x)[order])


def test_rows_of_one_class_and_without_known_values():
    bins, cuts = np.zeros((20, 2), int), [np.zeros(0)] * 2
    for y in (np.ones(20, int), np.zeros(20, int)):
        spool, _ = spooled(bins, y)
        score = spool.scratch()
        t = W.grow_tree(spool, cuts, G.Plan(), np.random.default_rng(0), score)
        assert t["feature"].tolist() == [-1] and (score == y[0]).all()
        trees = list(W.boost(spool, cuts, **N.TUNED["XGBoost"] | {"n_estimators": 3}, margin=spool.scratch(), rngs=N.seeds(3, 1)))
        assert [len(t["value"]) for t in trees] == [1, 1, 1] and W.boost_stumps(spool, 5) == []


@pytest.fixture
def large(monkeypatch):
    """Tables of some hundred rows are large ones, and their models aren't sent."""
    monkeypatch.setattr(N, "SMALL_ROWS", 100)
    monkeypatch.setattr(N, "SENT_BYTES", 0)


PARAMS = {"RandomForest": {"n_estimators": 150}, "AdaBoost": {"n_estimators": 80}, "XGBoost": {"n_estimators": 40}}


def test_all_rows_of_a_large_table_are_fitted(spark, large, monkeypatch):
    """No bound by rows: every fit sees what the table has, and is as good as the fits of small tables."""
    x, y = learnable(1500)
    rows, cols = table(spark, x, y)
    assert N.fit_sample(rows).count() == 1500
    models = N.load_models(N.fit_table(N.fit_sample(rows), cols, params=PARAMS))
    xt, yt = learnable(800, 9)
    assert set(models) == {(f,) for f in N.FAMILIES} and len(models["RandomForest",].roots) == 150
    assert len(models["XGBoost",].roots) == 40
    monkeypatch.setattr(N, "SMALL_ROWS", 10_000)
    small = N.load_models(N.fit_table(rows, cols, params=PARAMS))
    for f in N.FAMILIES:
        new, old = (auc(N.probability(f, m[f,], xt)[0], yt) for m in (models, small))
        assert new > old - 0.03, f
    tree = models["DecisionTree",]
    assert np.mean((tree.decision(x) > 0.5) == y) > 0.97  # a tree of any depth parts all its rows


def test_models_that_are_not_sent_score_the_same(spark, large, monkeypatch):
    x, y = learnable(400)
    x[5] = x[6]
    rows, cols = table(spark, x, y)
    rows = rows.unionByName(rows.where("tx_id < 20")).withColumn(  # ids that come twice or are missing
        "tx_id", F.when(F.col("tx_id") % 50 != 0, F.col("tx_id")))
    monkeypatch.setattr(N, "CHUNK_NODES", 300)
    monkeypatch.setattr(N, "SLICE_ROWS", 150)
    models = N.materialize(N.fit_table(rows, cols, params=PARAMS))
    assert models.where("family = 'RandomForest'").count() > 3 and N.sent_models(models) == {}
    assert np.allclose(N.importances(models, "RandomForest", 5), N.load_models(models)["RandomForest",].importances(5))
    keys = ["model", "tx_id", "label", "score", "pred"]
    got = N.score_models(rows, models, cols).toPandas()[keys].sort_values(keys, ignore_index=True)
    want = N.score_table(rows, N.load_models(models), cols).toPandas()[keys].sort_values(keys, ignore_index=True)
    assert len(got) == len(want) == 4 * 420
    for c in keys:
        assert np.allclose(got[c], want[c], equal_nan=True) if c != "model" else got[c].equals(want[c])
    monkeypatch.setattr(N, "SENT_BYTES", 1 << 20)
    mixed = N.score_models(rows, models, cols).toPandas()[keys].sort_values(keys, ignore_index=True)
    assert np.allclose(mixed.score, want.score) and N.sent_models(models)


@pytest.mark.parametrize("ratio", [None, 0.4])
def test_cross_validation_fits_and_scores_all_rows_of_large_folds(spark, large, ratio):
    x, y = learnable(1200)
    x = np.nan_to_num(x)
    rows, cols = table(spark, x, y, fold=np.arange(1200) % 3)
    grid = [(f, n, PARAMS.get(f, {}) | p) for f, n, p in (
        ("DecisionTree", "dt", {"criterion": "gini", "splitter": "best"}), ("RandomForest", "rf", {"n_estimators": 60}),
        ("AdaBoost", "ada", {}), ("XGBoost", "xgb", {}))]
    got = N.cross_validated(rows, cols, grid, 3, ratio=ratio).toPandas()
    assert len(got) == 4 * 3 * 1200 and (got.groupby(["model", "cv", "tx_id"]).size() == 1).all()
    assert ((got["set"] == "Validation") == (got.cv == got.tx_id % 3)).all() and (got.label == y[got.tx_id]).all()
    for model, part in got.groupby("model"):
        seen = part["set"] == "Training"
        assert part.score.between(0, 1).all()
        assert auc(part.score[~seen].to_numpy(), part.label[~seen].to_numpy()) > 0.75, model
        if model in ("DecisionTree", "RandomForest"):  # fitted on every training row
            assert np.mean(part.pred[seen] == part.label[seen]) > 0.97, model


def test_a_table_of_no_rows_and_one_of_null_labels(spark, large):
    x, y = learnable(200)
    rows, cols = table(spark, x, y)
    for none in (rows.limit(0), rows.withColumn("label", F.lit(None).cast("int"))):
        assert N._fitted_whole(none.where("label is not null"), cols, {"RandomForest": N.TUNED["RandomForest"]}, "label",
                               "tx_id", []).count() == 0
    half = rows.withColumn("label", F.when(F.col("tx_id") < 150, F.col("label")))
    models = N.fit_table(half, cols, ["RandomForest"], PARAMS)
    alone = N.fit_table(rows.where("tx_id < 150"), cols, ["RandomForest"], PARAMS)
    a, b = (N.load_models(m)["RandomForest",].decision(x) for m in (models, alone))
    assert np.array_equal(a, b)


def test_variants_of_a_small_table_are_dealt_out(spark, tmp_path):
    """Many tasks score the variants of one part, and a donor of the same value asks for no prediction."""
    from pyspark import TaskContext

    from txscore.operators import explain as X
    x, y = learnable(200)
    x = np.nan_to_num(x)
    x[:, 4] = 1.0
    rows, cols = table(spark, x, y)

    def predict(z):
        part = TaskContext.get().partitionId()
        (tmp_path / f"{part}-{np.random.default_rng().integers(1 << 60)}-{len(z)}").write_text("")
        return (z[:, 2] > 1).astype(int)

    got = {r.feature: r.importance_mean for r in X.permutation_importance(rows.coalesce(1), cols, predict, n_repeats=2).collect()}
    assert got["c4"] == got["c0"] == 0 and got["c2"] > 0
    names = [f.name.split("-") for f in tmp_path.iterdir()]
    assert len({n[0] for n in names}) > 1 and sum(int(n[2]) for n in names) <= 2 * 200 * 5
