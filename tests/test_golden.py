"""Golden checks against the published result tables."""

from pyspark.sql import functions as F

import golden as G
import pytest
from golden import CORRECTED_F1_ORDER, CV_F1, FOLD_MODELS, HOLDOUT
from txscore.operators import metrics as M
from txscore.operators import stats as ST


@pytest.mark.parametrize("scores, published, ratio", [
    ("CV_F1", "CORRECTED_F1", 1 / 9), ("CV_ROC_AUC", "CORRECTED_ROC_AUC", 1 / 9),
    ("CV_F1", "PLAIN_F1", None), ("CV_ROC_AUC", "PLAIN_ROC_AUC", None)])
def test_ttests_match_published(spark, scores, published, ratio):
    table, want = getattr(G, scores), getattr(G, published)
    rows = [("m", m, fold, table[fold][j]) for fold in range(10) for j, m in enumerate(FOLD_MODELS)]
    fs = spark.createDataFrame(rows, "metric string, model string, fold int, score double")
    diffs = ST.paired_differences(fs, CORRECTED_F1_ORDER)
    got = {(r["model_a"], r["model_b"]): (r["t_statistic"], r["p_value"])
           for r in ST.paired_ttests(diffs, test_train_ratio=ratio).collect()}
    assert len(got) == len(want) == 15
    for a, b, t, p in want:
        sign = 1 if (a, b) in got else -1  # the plain tables list some pairs the other way round
        gt, gp = got[(a, b) if sign == 1 else (b, a)]
        assert abs(sign * gt - t) <= 1e-10 * abs(t), (a, b, gt, t)
        assert abs(gp - p) <= 1e-12, (a, b, gp, p)


def test_ttest_matrix_mirrors(spark):
    rows = [("f1", m, fold, CV_F1[fold][j]) for fold in range(10) for j, m in enumerate(FOLD_MODELS)]
    fs = spark.createDataFrame(rows, "metric string, model string, fold int, score double")
    tests = ST.paired_ttests(ST.paired_differences(fs, CORRECTED_F1_ORDER), test_train_ratio=1 / 9)
    mat = {(r["model_a"], r["model_b"]): r for r in ST.ttest_matrix(tests).collect()}
    assert len(mat) == 36
    for a in FOLD_MODELS:
        assert mat[(a, a)]["t_statistic"] == 0.0 and mat[(a, a)]["p_value"] == 1.0
        for b in FOLD_MODELS:
            assert mat[(a, b)]["t_statistic"] == -mat[(b, a)]["t_statistic"]
            assert mat[(a, b)]["p_value"] == mat[(b, a)]["p_value"]
    assert mat[("KNN", "RandomForest")]["t_shown"] is None  # p = 0.448


def test_holdout_metrics_from_confusion(spark):
    rows = [(m, c[0][0], c[0][1], c[1][0], c[1][1]) for m, c, *_ in HOLDOUT]
    conf = spark.createDataFrame(rows, "model string, tn long, fp long, fn long, tp long")
    got = {r["model"]: r for r in M.with_rates(conf).withColumn("cm", M.confusion_json()).collect()}
    names = ["accuracy", "specificity", "precision", "recall", "f1", "precision_weighted",
             "recall_weighted", "f1_weighted", "balanced_accuracy"]
    for m, c, *vals in HOLDOUT:
        for name, v in zip(names, vals):
            assert abs(got[m][name] - v) <= 1e-12, (m, name, got[m][name], v)
        assert got[m]["cm"] == f"[[{c[0][0]}, {c[0][1]}], [{c[1][0]}, {c[1][1]}]]"


def test_derived_specificity_clamp(spark):
    df = spark.createDataFrame([(0.9, 0.5), (0.2, 0.9), (1.0, 0.5)], "bal double, rec double")
    got = [r[0] for r in df.select(M.specificity_from_balanced(F.col("bal"), F.col("rec"))).collect()]
    assert got == [1.0, 0.0, 1.0]
