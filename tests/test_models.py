"""Rows-and-invariants checks of the model queries that have no SQL oracle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import MEDIUM, SMALL
from txscore.operators import ensembles as N
from txscore.operators.bayes import GaussianNBModel
from txscore.plans import learning as L

Q = E.queries()
METRICS = ["accuracy", "balanced_accuracy", "precision", "recall", "f1", "specificity", "roc_auc", "pr_auc"]


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    values, at, n = np.unique(score[order], return_inverse=True, return_counts=True)
    rank[order] = (np.cumsum(n) - (n - 1) / 2)[at]
    pos = (label == 1).sum()
    return (rank[label == 1].sum() - pos * (pos + 1) / 2) / pos / (len(label) - pos)


def learnable(n=1500, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    y = ((x[:, 0] * x[:, 1] + x[:, 2]) > 1.5).astype(int)
    x[rng.random(x.shape) < 0.02] = np.nan
    return x, y


def test_grid_search_report(spark):
    rows = Q["grid_search_report"](spark, SMALL).collect()
    assert sorted((r["model"], r["selection"], r["set"]) for r in rows) == sorted(
        (m, s, t) for m in L.MODELS for s, sets in (
            ("best_candidate", ("Test", "Training", "Validation")), ("per_metric_max", ("Training", "Validation")))
        for t in sets)
    for r in rows:
        for m in METRICS:
            assert r[m] is None or 0.0 <= r[m] <= 1.0


def test_grid_report_against_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [("M", c, cv, s, i, int(i % 3 == 0), float(rng.random()), int(rng.random() < 0.4))
            for c in ("a", "b", "c") for cv in range(4) for s in ("Training", "Validation") for i in range(30)]
    df = spark.createDataFrame(rows, "model string, candidate string, cv int, set string, tx_id int, label int, "
                                     "score double, pred int")
    L.register_scorer("cost", lambda: -(F.col("fp") + 10 * F.col("fn")).cast("double"))
    try:
        means, best = L.grid_report(df, refit="cost")
        got = {(r.candidate, r.set): r for r in means.collect()}
    finally:
        del L.SCORERS["cost"]
    cost = {}
    for c in "abc":
        for s in ("Training", "Validation"):
            own = [r for r in rows if r[1] == c and r[3] == s]
            per = [[r for r in own if r[2] == cv] for cv in range(4)]
            cost[c, s] = -np.mean([sum(r[7] > r[5] for r in f) + 10 * sum(r[7] < r[5] for r in f) for f in per])
            assert got[c, s].cost == pytest.approx(cost[c, s])
            assert got[c, s].roc_auc == pytest.approx(np.mean(
                [auc(np.array([r[6] for r in f]), np.array([r[5] for r in f])) for f in per]))
    assert best.first().candidate == max("abc", key=lambda c: (cost[c, "Validation"], -ord(c)))


def test_cv_model_scores(spark):
    rows = Q["cv_model_scores"](spark, SMALL).collect()
    assert len(rows) == len(L.SCORERS) * len(L.MODELS) * 10
    assert {r["model"] for r in rows} == set(L.MODELS)
    assert all(r["score"] is None or 0.0 <= r["score"] <= 1.0 for r in rows)


def small_folds(spark, n=600, n_folds=3):
    """(table, ids, matrix, labels, folds) of rows with repeated vectors and a rare class."""
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(n, 2)), 1)
    y = ((x.sum(1) + rng.normal(size=n)) > 2.2).astype(int)
    fold = np.arange(n) % n_folds
    rows = [(i, int(y[i]), int(fold[i]), float(x[i, 0]), float(x[i, 1])) for i in range(n)]
    return spark.createDataFrame(rows, "tx_id long, label int, fold int, a double, b double"), x, y, fold


def test_cross_validation_fits_and_scores_whole_folds(spark):
    """Naive Bayes and nearest neighbours against numpy over all rows; the bound of the tree fits
    takes no row out of any set."""
    folds, x, y, fold = small_folds(spark)
    grid = [("NaiveBayes", "nb", {"var_smoothing": 1e-2}), ("KNN", "k3", {"n_neighbors": 3}),
            ("KNN", "k7", {"n_neighbors": 7}), ("DecisionTree", "dt", {}),
            ("RandomForest", "rf", {"n_estimators": 130})]
    got = N.cross_validated(folds, ["a", "b"], grid, 3, fit_rows=60).toPandas()
    assert len(got) == len(grid) * 3 * len(x)
    assert (got.groupby(["model", "candidate", "tx_id", "cv"]).size() == 1).all()
    assert ((got["set"] == "Validation") == (got.cv == fold[got.tx_id])).all()
    for cv in range(3):
        own = np.flatnonzero(fold != cv)
        part = {c: p.sort_values("tx_id").score.to_numpy() for c, p in got[got.cv == cv].groupby("candidate")}
        lj = [np.log((y[own] == c).mean()) - 0.5 * (np.log(2 * np.pi * v) + (x - x[own][y[own] == c].mean(0)) ** 2 / v)
              .sum(1) for c in (0, 1) for v in [x[own][y[own] == c].var(0) + 1e-2 * x[own].var(0).max()]]
        assert np.allclose(part["nb"], 1 / (1 + np.exp(lj[0] - lj[1])))
        d = np.abs(x[:, None] - x[None, own]).sum(2)
        for k in (3, 7):
            near = np.argsort(d, axis=1, kind="stable")[:, :k]
            dk = np.take_along_axis(d, near, 1)
            zero = dk == 0
            w = np.where(zero.any(1, keepdims=True), zero, 1 / np.where(zero, 1, dk))
            assert np.allclose(part[f"k{k}"], (w * (y[own][near] == 1)).sum(1) / w.sum(1))


def test_fit_sample_keeps_the_share_of_every_class(spark):
    rows = spark.range(20_000).select(F.col("id").alias("tx_id"), (F.col("id") % 2).cast("int").alias("cv"),
                                      (F.col("id") < 20).cast("int").alias("label"))
    for n in (100, 1000):
        got = N.fit_sample(rows, n=n, by=["cv"]).toPandas()
        assert (got.groupby("cv").size() == n).all() and got.tx_id.is_unique
        assert (got.groupby("cv").label.sum() == 1).all()
    assert N.fit_sample(rows, n=10_000, by=["cv"]).count() == 20_000


def test_fit_sample_of_one_part_of_a_split(spark):
    """The train part of a split holds the upper three quarters of the hashes."""
    from txscore.operators.sampling import stratified_split
    rows = spark.range(20_000).select(F.col("id").alias("tx_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    train = stratified_split(rows).where("part = 'train'")
    got = N.fit_sample(train, n=1000).toPandas()
    assert len(got) == 1000 and got.tx_id.is_unique and got.label.sum() == 100
    hashed = train.where("label = 1").select("tx_id", N.row_hash("tx_id").alias("h")).orderBy("h").limit(100)
    assert {r.tx_id for r in hashed.collect()} == set(got.tx_id[got.label == 1])
    none = N.fit_sample(train.withColumn("tx_id", F.when(F.col("tx_id") % 2 == 0, F.col("tx_id"))), n=1000)
    assert none.count() == 1000 and {r.label: r["count"] for r in none.groupBy("label").count().collect()} == {0: 900, 1: 100}


def test_a_fold_without_two_minority_rows_is_an_error(spark):
    folds, *_ = small_folds(spark)
    rare = folds.withColumn("label", (F.col("tx_id") == 0).cast("int"))
    with pytest.raises(ValueError, match="fewer than two minority rows"):
        N.cross_validated(rare, ["a", "b"], [("NaiveBayes", "nb", {})], 3, ratio=0.2)


def test_cv_model_scores_measures_every_train_row(spark, monkeypatch):
    """With a fit sample far smaller than the train part."""
    seen = []
    bounded, measured = N.fit_sample, L.M.fold_metrics
    monkeypatch.setattr(N, "fit_sample", lambda *a, **o: bounded(*a, **o | {"n": 100}))
    monkeypatch.setattr(L.M, "fold_metrics", lambda df, by: seen.append(measured(df, by)) or seen[-1])
    L.cv_model_scores(spark, SMALL)
    train = L._train_test(spark, SMALL)[0].count()
    sizes = {r.model: r.n for r in seen[0].groupBy("model").agg(F.sum(F.expr("tn + fp + fn + tp")).alias("n")).collect()}
    assert sizes == dict.fromkeys(L.MODELS, train) and train > 700


def test_grid_search_measures_and_refits_on_every_train_row(spark, monkeypatch):
    """With a fit sample far smaller than the train part."""
    seen, fitted, refs = [], [], []
    bounded, measured, bayes, near = N.fit_sample, L.M.fold_metrics, GaussianNBModel.fit, L.knn_join
    monkeypatch.setattr(N, "fit_sample", lambda *a, **o: bounded(*a, **o | {"n": 100}))
    monkeypatch.setattr(L.M, "fold_metrics", lambda df, by: seen.append(measured(df, by)) or seen[-1])
    monkeypatch.setattr(GaussianNBModel, "fit", staticmethod(
        lambda df, *a, **o: fitted.append(df.count()) or bayes(df, *a, **o)))
    monkeypatch.setattr(L, "knn_join", lambda q, r, *a, **o: refs.append(r.count()) or near(q, r, *a, **o))
    grid = [("NaiveBayes", "nb", {"var_smoothing": 1e-5}), ("KNN", "k", {"n_neighbors": 3}), ("DecisionTree", "dt", {})]
    L.grid_search(spark, SMALL, n_folds=3, grid=grid)
    train = L._train_test(spark, SMALL)[0].count()
    sizes = seen[0].groupBy("model", "set").agg(F.sum(F.expr("tn + fp + fn + tp")).alias("n")).collect()
    assert {(r.model, r.set): r.n for r in sizes} == {
        (f, s): k * train for f, _, _ in grid for s, k in (("Validation", 1), ("Training", 2))}
    assert fitted == refs == [train] and train > 700


@pytest.mark.parametrize("name", ["dt_scores", "rf_scores", "gbt_scores", "samme_scores"])
def test_family_scores_vary_and_are_probabilities(spark, name):
    rows = Q[name](spark, SMALL).collect()
    assert rows and all(0.0 <= r["score"] <= 1.0 and r["pred"] in (0, 1) for r in rows)
    assert len({r["score"] for r in rows}) > 1


def test_six_models_end_to_end(spark):
    rows = Q["model_scores"](spark, MEDIUM).toPandas()
    assert set(rows.model) == set(L.MODELS) and rows.groupby("model").size().nunique() == 1
    for model, part in rows.groupby("model"):
        assert part.score.nunique() > 1 and part.score.between(0, 1).all()
        assert auc(part.score.to_numpy(), part.label.to_numpy()) > 0.5, model


def test_neighbours_refer_to_all_balanced_rows(spark, monkeypatch):
    """With a fit sample far smaller than the train part."""
    folds, x, y, _ = small_folds(spark)
    bounded, sizes = N.fit_sample, []
    monkeypatch.setattr(N, "fit_sample", lambda *a, **o: bounded(*a, **o | {"n": 100}))
    monkeypatch.setattr(N, "fit_table", lambda sample, *a, **o: sizes.append(sample.count()) or sample.select("id"))
    _, refs, _ = L.fitted_models(spark, folds, ["a", "b"])
    need = max(0, int(L.SMOTE_RATIO * (y == 0).sum() - y.sum()))
    assert refs.count() == len(x) + need and sizes[0] <= 100


def test_report_log_keeps_both_runs(spark):
    rows = Q["report_log"](spark, SMALL).collect()
    assert {(r.run_id, r.set) for r in rows} == {("grid", "Training"), ("grid", "Validation"), ("grid", "Test"),
                                                 ("models", "Test")}
    assert all(sum(r.model == m for r in rows) == 4 for m in L.MODELS)


@pytest.mark.parametrize("family", N.FAMILIES)
def test_family_learns_and_survives_storage(spark, family, tmp_path):
    x, y = learnable()
    cols = [f"c{i}" for i in range(5)]
    sample = spark.createDataFrame([(i, int(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y, strict=True))],
                                   "tx_id long, label int, " + ", ".join(f"{c} double" for c in cols))
    params = {"RandomForest": {"n_estimators": 150}, "AdaBoost": {"n_estimators": 200}}
    table = N.fit_table(sample, cols, [family], params)
    table.write.parquet(f"{tmp_path}/m")
    loaded = N.load_models(spark.read.parquet(f"{tmp_path}/m"))
    xt, yt = learnable(600, 9)
    score, pred = N.probability(family, loaded[family,], xt)
    assert auc(score, yt) > 0.75 and len(np.unique(score)) > 1
    rows = spark.createDataFrame([(i, *map(float, a)) for i, a in enumerate(xt)], "tx_id long, " + ", ".join(
        f"{c} double" for c in cols))
    scored = N.score_table(rows, loaded, cols, keep=["tx_id"]).orderBy("tx_id").toPandas()
    assert np.array_equal(scored.score, score) and (scored.model == family).all()
    share = loaded[family,].importances(5)
    assert share.sum() == pytest.approx(1) and share[:3].sum() > share[3:].sum()


def test_tuned_rounds_are_run(spark):
    x, y = learnable(300)
    cols = [f"c{i}" for i in range(5)]
    rows = spark.createDataFrame([(i, int(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y, strict=True))],
                                 "tx_id long, label int, " + ", ".join(f"{c} double" for c in cols))
    models = N.load_models(N.fit_table(rows, cols))
    assert len(models["AdaBoost",].roots) > 100
    assert len(models["XGBoost",].roots) == len(models["RandomForest",].roots) == 1000


def test_models_over_the_bound_are_not_collected(spark, monkeypatch):
    models = spark.createDataFrame([("XGBoost", 0, bytearray(100))], "family string, chunk int, model binary")
    monkeypatch.setattr(N, "MODEL_BYTES", 99)
    with pytest.raises(ValueError, match="over 99"):
        N.load_models(models)


def test_positive_weight_moves_the_first_leaf():
    """One round without splits: the leaf is the weighted Newton step."""
    x, y = np.zeros((10, 1)), np.array([1] * 2 + [0] * 8)
    t = N.fit_boosted(x, y, 1, 15, 1.0, 1.0, 1, 4, 1.1)
    g, h = 4 * 2 * 0.5 - 8 * 0.5, (4 * 2 + 8) * 0.25
    assert t.decision(x)[0] == pytest.approx(g / (h + 1))


def test_gamma_stops_splits_below_its_loss_reduction():
    x, y = learnable(400)
    sizes = [len(N.fit_boosted(x, y, 20, 15, 0.05, g, 1, 4, 0.8).feature) for g in (0.0, 1.0, 1e9)]
    assert sizes[0] >= sizes[1] > sizes[2] == 20


def test_bayes_with_one_class(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(5)], "x double, label int")
    assert {r.score for r in GaussianNBModel.fit(df, ["x"]).transform(df).collect()} == {1.0}
    none = df.withColumn("label", F.lit(0))
    assert {r.score for r in GaussianNBModel.fit(none, ["x"]).transform(df).collect()} == {0.0}


def test_surrogate_rules_cover_all_rows(spark):
    rows = Q["surrogate_rules"](spark, SMALL).collect()
    assert rows and all(r["rule"] for r in rows)
    assert all(r["purity"] is None or 0.0 <= r["purity"] <= 1.0 for r in rows)
    assert len({r["fidelity"] for r in rows}) == 1 and 0.0 <= rows[0]["fidelity"] <= 1.0


def test_stream_votes_equal_batch_votes(spark):
    batch = {r.tx_id: tuple(r) for r in Q["model_vote"](spark, SMALL).collect()}
    stream = {r.tx_id: tuple(r) for r in Q["stream_model_vote"](spark, SMALL).collect()}
    assert len(stream) == 1000 and all(stream[i] == v for i, v in batch.items())


def test_several_micro_batches_and_a_replayed_epoch(spark, tmp_path):
    from txscore.streaming import scoring as ST
    spark.range(40).repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    epochs = []

    def double(batch):
        epochs.append(batch.count())
        return batch.select((F.col("id") * 2).alias("id"))

    out = ST.run_available_now(stream, spark, "test", per_batch=double)
    assert len(epochs) == 4 and sorted(r.id for r in out.collect()) == list(range(0, 80, 2))
    path = f"{tmp_path}/out"
    for _ in range(2):  # the same epoch twice, as after a failure
        for epoch in (0, 1):
            ST.write_epoch(spark.range(epoch * 10, epoch * 10 + 10), path, epoch)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(20))
