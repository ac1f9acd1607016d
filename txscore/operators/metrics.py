"""Exact binary-classification metrics over a long score table.

Input: ``(…group…, label INT 0/1, score DOUBLE, pred INT 0/1)``; one row per
scored transaction and model. Everything is an aggregation or a projection:

* confusion counts and the ratio metrics derived from them,
* one cumulative table per group over the distinct scores in descending order
  (``score_curve``), pre-aggregated to (score, pos, neg) first so that ties
  collapse and the shuffle carries one row per distinct score; the running sums
  come from ``ordered_prefix`` (range partitioned, no one-task window),
* ROC AUC (trapezoid = mid-rank statistic) and average precision as sums over
  that table, ROC / PR points, and the TPR operating point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.functions.algebra import safe_ratio
from txscore.operators.ordered import join_small, ordered_prefix, ordered_row_number
from txscore.session import materialize

GroupCols = Sequence[str]

RATE_METRICS = ["accuracy", "specificity", "precision", "recall", "f1",
                "precision_weighted", "recall_weighted", "f1_weighted",
                "balanced_accuracy"]


def confusion(scored: DataFrame, by: GroupCols = ("model",),
              label: str = "label", pred: str = "pred") -> DataFrame:
    """[[tn, fp], [fn, tp]] per group with labels fixed to {0, 1}."""
    y, p = F.col(label), F.col(pred)

    def cnt(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    return scored.groupBy(*by).agg(
        cnt((y == 0) & (p == 0)).alias("tn"), cnt((y == 0) & (p == 1)).alias("fp"),
        cnt((y == 1) & (p == 0)).alias("fn"), cnt((y == 1) & (p == 1)).alias("tp"))


def rate_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Ratio metrics from confusion counts; 0.0 wherever a denominator is 0."""
    tn, fp, fn, tp = (c.cast("double") for c in (tn, fp, fn, tp))
    n = tn + fp + fn + tp
    spec = safe_ratio(tn, tn + fp)
    prec = safe_ratio(tp, tp + fp)
    rec = safe_ratio(tp, tp + fn)
    f1 = safe_ratio(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn)
    prec0 = safe_ratio(tn, tn + fn)
    f1_0 = safe_ratio(F.lit(2.0) * tn, F.lit(2.0) * tn + fn + fp)
    s0, s1 = tn + fp, fn + tp
    return {
        "accuracy": safe_ratio(tn + tp, n),
        "specificity": spec,
        "precision": prec,
        "recall": rec,
        "f1": f1,
        "precision_weighted": safe_ratio(s0 * prec0 + s1 * prec, n),
        "recall_weighted": safe_ratio(s0 * spec + s1 * rec, n),
        "f1_weighted": safe_ratio(s0 * f1_0 + s1 * f1, n),
        "balanced_accuracy": (spec + rec) / F.lit(2.0),
    }


def with_rates(conf: DataFrame) -> DataFrame:
    cols = rate_columns(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    return conf.select("*", *[c.alias(n) for n, c in cols.items()])


def confusion_json(tn="tn", fp="fp", fn="fn", tp="tp") -> Column:
    """The 2x2 matrix as the JSON text a Python ``json.dumps`` would write."""
    s = lambda c: F.col(c).cast("string")
    return F.concat(F.lit("[["), s(tn), F.lit(", "), s(fp), F.lit("], ["),
                    s(fn), F.lit(", "), s(tp), F.lit("]]"))


def specificity_from_balanced(bal: Column, rec: Column) -> Column:
    """Derived specificity ``max(0, min(1, 2*balanced - recall))``."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(2.0) * bal - rec))


# --- ranking metrics -------------------------------------------------------

def score_summary(scored: DataFrame, by: GroupCols = ("model",), label: str = "label",
                  score: str = "score", pred: str = "pred") -> DataFrame:
    """One row per (group, distinct score, prediction) with positive / negative
    counts, written once to the shared checkpoint folder. Every metric is
    derived from it, so the (possibly expensive) scored input is read once."""
    y = F.col(label).cast("long")
    summary = (scored.groupBy(*by, F.col(score).alias("score"), F.col(pred).cast("int").alias("pred"))
               .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))
    return materialize(summary)


def confusion_from_summary(summary: DataFrame, by: GroupCols = ("model",)) -> DataFrame:
    p1 = F.col("pred") == 1
    return summary.groupBy(*by).agg(
        F.sum(F.when(~p1, F.col("neg")).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when(p1, F.col("neg")).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(~p1, F.col("pos")).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when(p1, F.col("pos")).otherwise(0)).cast("long").alias("tp"))


def score_curve(scored: DataFrame, by: GroupCols = ("model",), label: str = "label",
                score: str = "score", summary: DataFrame | None = None) -> DataFrame:
    """Distinct scores per group, descending, with cumulative tp/fp.

    Columns: by…, score, pos, neg, tp, fp, idx (1-based rank of the distinct
    score), n_pos, n_neg (group totals).
    """
    if summary is not None:
        per_score = summary.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    else:
        y = F.col(label).cast("long")
        per_score = (scored.groupBy(*by, F.col(score).alias("score"))
                     .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))
    cum = ordered_prefix(per_score, by, [F.col("score").desc()], ["pos", "neg"])
    totals = per_score.groupBy(*by).agg(F.sum("pos").alias("n_pos"),
                                        F.sum("neg").alias("n_neg"))
    return (join_small(cum, totals, list(by))
            .withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp"))


def fold_metrics(scored: DataFrame, by: GroupCols) -> DataFrame:
    """Confusion counts, rate metrics, ROC AUC and AP per group from one summary."""
    summary = score_summary(scored, by)
    rates = with_rates(confusion_from_summary(summary, by))
    rank = ranking_metrics(score_curve(None, by, summary=summary), by)
    return rates.join(rank, list(by), "left")


def ranking_metrics(curve: DataFrame, by: GroupCols = ("model",)) -> DataFrame:
    """ROC AUC (ties count one half) and average precision per group."""
    dec = "decimal(38,0)"
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    # trapezoid between consecutive ROC points, times 2*P*N: neg_i*(tp_{i-1}+tp_i)
    twice_area = F.sum((neg * (F.lit(2) * tp - pos)).cast(dec))
    ap_sum = F.sum(pos.cast("double") * (tp.cast("double") / (tp + fp).cast("double")))
    agg = curve.groupBy(*by).agg(
        twice_area.alias("_area2"), ap_sum.alias("_ap"),
        F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"))
    npos, nneg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    return agg.select(
        *by,
        F.try_divide(F.col("_area2").cast("double"), F.lit(2.0) * npos * nneg).alias("roc_auc"),
        F.try_divide(F.col("_ap"), npos).alias("pr_auc"))


def metrics_report(scored: DataFrame, by: GroupCols = ("model",)) -> DataFrame:
    """Confusion counts, rate metrics, ROC AUC and PR AUC (average precision)."""
    summary = score_summary(scored, by)
    rates = with_rates(confusion_from_summary(summary, by)).withColumn("confusion_matrix", confusion_json())
    rank = ranking_metrics(score_curve(None, by, summary=summary), by)
    return rates.join(rank, list(by), "left")


def roc_points(curve: DataFrame, by: GroupCols = ("model",),
               drop_intermediate: bool = True) -> DataFrame:
    """ROC points (threshold, fpr, tpr) including the leading (NULL=+inf, 0, 0).

    With ``drop_intermediate`` a point is kept only where the slope changes
    (first and last distinct thresholds are always kept). ``pos_idx`` numbers
    the kept finite-threshold points from 1 in descending threshold order.
    """
    by = list(by)
    if drop_intermediate:
        nxt = curve.select(*by, (F.col("idx") - 1).alias("idx"),
                           F.col("pos").alias("_npos"), F.col("neg").alias("_nneg"))
        kept = (curve.join(nxt, by + ["idx"], "left")
                .where((F.col("idx") == 1) | F.col("_npos").isNull()
                       | (F.col("_npos") != F.col("pos")) | (F.col("_nneg") != F.col("neg")))
                .drop("_npos", "_nneg"))
        kept = ordered_row_number(kept, by, [F.col("score").desc()], "pos_idx")
    else:
        kept = curve.withColumn("pos_idx", F.col("idx"))
    finite = kept.select(
        *by, F.col("score").alias("threshold"), "pos_idx",
        F.try_divide(F.col("fp").cast("double"), F.col("n_neg").cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("n_pos").cast("double")).alias("tpr"))
    origin = (curve.select(*by).distinct()
              .select(*by, F.lit(None).cast("double").alias("threshold"),
                      F.lit(0).cast("long").alias("pos_idx"),
                      F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")))
    return origin.unionByName(finite)


def pr_points(curve: DataFrame, by: GroupCols = ("model",)) -> DataFrame:
    """Precision / recall per distinct threshold plus the closing (1, 0) point."""
    by = list(by)
    finite = curve.select(
        *by, F.col("score").alias("threshold"),
        safe_ratio(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
        .alias("precision"),
        F.when(F.col("n_pos") == 0, F.lit(1.0))
         .otherwise(F.col("tp").cast("double") / F.col("n_pos").cast("double")).alias("recall"))
    closing = (curve.select(*by).distinct()
               .select(*by, F.lit(None).cast("double").alias("threshold"),
                       F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")))
    return finite.unionByName(closing)


def operating_point(roc: DataFrame, by: GroupCols = ("model",), target: float = 0.8) -> DataFrame:
    """First reduced-ROC point with TPR >= target; one step back if that TPR is 1.

    Mirrors the index rule of the source pipeline on the curve without its
    +inf point: no hit, or a step back from the first point, resolves to the last
    point (a Python ``[-1]``). ``point_index`` is the resolved 0-based index.
    """
    by = list(by)
    pts = roc.where(F.col("pos_idx") > 0)
    stats = pts.groupBy(*by).agg(
        F.max("pos_idx").alias("_last"),
        F.min(F.when(F.col("tpr") >= F.lit(target), F.col("pos_idx"))).alias("_hit"))
    hit_tpr = pts.select(*by, F.col("pos_idx").alias("_hit"), F.col("tpr").alias("_hit_tpr"))
    stats = stats.join(hit_tpr, by + ["_hit"], "left")
    pick = F.when(F.col("_hit").isNull(), F.col("_last")) \
            .when(F.col("_hit_tpr") == F.lit(1.0), F.col("_hit") - 1) \
            .otherwise(F.col("_hit"))
    stats = stats.select(*by, F.when(pick == 0, F.col("_last")).otherwise(pick).alias("pos_idx"))
    return (pts.join(stats, by + ["pos_idx"])
            .select(*by, F.col("threshold").alias("threshold80"),
                    F.col("tpr").alias("tpr80"), F.col("fpr").alias("fpr80"),
                    (F.col("pos_idx") - 1).alias("point_index")))


def leaderboard(report: DataFrame, metrics: Sequence[str] = tuple(RATE_METRICS) + ("roc_auc", "pr_auc"),
                by: str = "model") -> DataFrame:
    """Long (metric, model, value, rank) table; rank 1 = best (ties share)."""
    long = report.unpivot([by], list(metrics), "metric", "value")
    w = Window.partitionBy("metric").orderBy(F.col("value").desc())
    return long.select("metric", by, "value", F.rank().over(w).alias("rank"))
