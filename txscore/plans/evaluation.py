"""Evaluation queries: metric report, curves, operating point, leaderboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from txscore.functions.algebra import r6
from txscore.operators import metrics as M
from txscore.plans import sqlkit as S
from txscore.plans.registry import register
from txscore.sources.tables import SCORES_SQL, TX_SQL, score_table, tx_view, with_ctes

REPORT_METRICS = M.RATE_METRICS + ["roc_auc", "pr_auc"]


def _scores(spark, sf_dir):
    return score_table(tx_view(spark, sf_dir))


def metrics_report_df(spark, sf_dir):
    rep = M.metrics_report(_scores(spark, sf_dir))
    return rep.select("model", "tn", "fp", "fn", "tp",
                      *[r6(m).alias(m) for m in REPORT_METRICS], "confusion_matrix")


_CURVE_SQL = """per AS (
  SELECT model, score, CAST(SUM(label) AS BIGINT) AS pos, CAST(SUM(1 - label) AS BIGINT) AS neg
  FROM scores GROUP BY model, score),
cum AS (
  SELECT model, score, pos, neg,
         SUM(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         SUM(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
         ROW_NUMBER() OVER (PARTITION BY model ORDER BY score DESC) AS idx,
         SUM(pos) OVER (PARTITION BY model) AS n_pos,
         SUM(neg) OVER (PARTITION BY model) AS n_neg
  FROM per)"""

_rates = S.rates()
_METRICS_SQL = with_ctes(TX_SQL, SCORES_SQL, """conf AS (
  SELECT model,
         CAST(SUM(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(SUM(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(SUM(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(SUM(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM scores GROUP BY model)""", _CURVE_SQL, """rk AS (
  SELECT model,
         CAST(SUM(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE) / (2.0 * MAX(n_pos) * MAX(n_neg)) AS roc_auc,
         SUM(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / MAX(n_pos) AS pr_auc
  FROM cum GROUP BY model)""", body="SELECT c.model, c.tn, c.fp, c.fn, c.tp, "
    + ", ".join(f"{S.r6(e)} AS {n}" for n, e in _rates.items())
    + f", {S.r6('rk.roc_auc')} AS roc_auc, {S.r6('rk.pr_auc')} AS pr_auc, "
    "'[[' || c.tn || ', ' || c.fp || '], [' || c.fn || ', ' || c.tp || ']]' AS confusion_matrix "
    "FROM conf c LEFT JOIN rk ON c.model = rk.model")

register("metrics_report", "EVL-1,EVL-2,EVL-3,EVL-4,PRJ-15,SNK-4,UDF-2", _METRICS_SQL)(metrics_report_df)


def roc_points_df(spark, sf_dir):
    curve = M.score_curve(_scores(spark, sf_dir))
    roc = M.roc_points(curve)
    return roc.select("model", "pos_idx", r6("threshold").alias("threshold"),
                      r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


_ROC_SQL = with_ctes(TX_SQL, SCORES_SQL, _CURVE_SQL, """nxt AS (
  SELECT c.*, n.pos AS npos, n.neg AS nneg
  FROM cum c LEFT JOIN cum n ON n.model = c.model AND n.idx = c.idx + 1),
kept AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY score DESC) AS pos_idx
  FROM nxt WHERE idx = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg)""",
    body=f"""SELECT model, CAST(0 AS BIGINT) AS pos_idx, CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
FROM (SELECT DISTINCT model FROM cum)
UNION ALL
SELECT model, pos_idx, {S.r6('score')}, {S.r6('CAST(fp AS DOUBLE) / n_neg')}, {S.r6('CAST(tp AS DOUBLE) / n_pos')}
FROM kept""")

register("roc_points", "EVL-5,EVL-8", _ROC_SQL)(roc_points_df)


def pr_points_df(spark, sf_dir):
    curve = M.score_curve(_scores(spark, sf_dir))
    return M.pr_points(curve).select("model", r6("threshold").alias("threshold"),
                                     r6("precision").alias("precision"),
                                     r6("recall").alias("recall"))


_PR_SQL = with_ctes(TX_SQL, SCORES_SQL, _CURVE_SQL, body=f"""
SELECT model, {S.r6('score')} AS threshold, {S.r6(S.ratio('tp', 'tp + fp'))} AS precision,
       {S.r6('CASE WHEN n_pos = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / n_pos END')} AS recall
FROM cum
UNION ALL
SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE FROM cum""")

register("pr_points", "EVL-6", _PR_SQL)(pr_points_df)


def operating_point_df(spark, sf_dir):
    curve = M.score_curve(_scores(spark, sf_dir))
    op = M.operating_point(M.roc_points(curve))
    return op.select("model", r6("threshold80").alias("threshold80"), r6("tpr80").alias("tpr80"),
                     r6("fpr80").alias("fpr80"), F.col("point_index").cast("long").alias("point_index"))


_OP_SQL = with_ctes(TX_SQL, SCORES_SQL, _CURVE_SQL, """nxt AS (
  SELECT c.*, n.pos AS npos, n.neg AS nneg
  FROM cum c LEFT JOIN cum n ON n.model = c.model AND n.idx = c.idx + 1),
kept AS (
  SELECT model, score, CAST(tp AS DOUBLE) / n_pos AS tpr, CAST(fp AS DOUBLE) / n_neg AS fpr,
         ROW_NUMBER() OVER (PARTITION BY model ORDER BY score DESC) AS j
  FROM nxt WHERE idx = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg),
st AS (
  SELECT model, MAX(j) AS last_j, MIN(CASE WHEN tpr >= 0.8 THEN j END) AS hit FROM kept GROUP BY model),
pick AS (
  SELECT st.model,
         CASE WHEN st.hit IS NULL THEN st.last_j
              WHEN k.tpr = 1.0 THEN (CASE WHEN st.hit - 1 = 0 THEN st.last_j ELSE st.hit - 1 END)
              ELSE st.hit END AS j
  FROM st LEFT JOIN kept k ON k.model = st.model AND k.j = st.hit)""",
    body=f"""SELECT k.model, {S.r6('k.score')} AS threshold80, {S.r6('k.tpr')} AS tpr80,
       {S.r6('k.fpr')} AS fpr80, CAST(k.j - 1 AS BIGINT) AS point_index
FROM kept k JOIN pick p ON k.model = p.model AND k.j = p.j""")

register("operating_point_tpr80", "EVL-7", _OP_SQL)(operating_point_df)


def leaderboard_df(spark, sf_dir):
    rep = M.metrics_report(_scores(spark, sf_dir))
    rounded = rep.select("model", *[r6(m).alias(m) for m in REPORT_METRICS])
    lb = M.leaderboard(rounded, REPORT_METRICS)
    return lb.select("metric", "model", "value", F.col("rank").cast("long").alias("rank"))


_LB_SQL = _METRICS_SQL.replace("SELECT c.model, c.tn", "SELECT c.model AS model, c.tn", 1)
_LB_SQL = with_ctes(
    "rep AS (" + _LB_SQL + ")",
    "lng AS (UNPIVOT rep ON " + ", ".join(REPORT_METRICS) + " INTO NAME metric VALUE value)",
    body="SELECT metric, model, value, CAST(RANK() OVER (PARTITION BY metric ORDER BY value DESC) AS BIGINT) AS rank FROM lng")

register("metric_leaderboard", "EVL-9", _LB_SQL)(leaderboard_df)
