"""Model-comparison queries: cross-validated fold scores, paired and corrected
t-tests, the mirrored t/p matrix, Shapiro-Wilk and Q-Q data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.functions import distributions as D
from txscore.functions.algebra import r6
from txscore.functions.hashing import hash_sql
from txscore.operators import metrics as M
from txscore.operators import sampling as SM
from txscore.operators import stats as ST
from txscore.plans import sqlkit as S
from txscore.plans.registry import CATALOG, register
from txscore.sources.tables import SCORE_MODELS, SCORES_SQL, TX_SQL, read_table, score_table, tx_view, with_ctes

N_FOLDS = 10
RATIO = 1.0 / (N_FOLDS - 1)   # n_test / n_train of one fold split


def cv_fold_scores(spark, sf_dir) -> DataFrame:
    """(metric, model, fold, score): F1 and ROC AUC of each scorer on each of
    10 stratified folds of the transaction view."""
    scored = score_table(SM.stratified_folds(tx_view(spark, sf_dir), N_FOLDS), keep=["fold"])
    m = M.fold_metrics(scored, ["model", "fold"])
    f1 = m.select(F.lit("f1").alias("metric"), "model", "fold", F.col("f1").alias("score"))
    auc = m.select(F.lit("roc_auc").alias("metric"), "model", "fold", F.col("roc_auc").alias("score"))
    return f1.unionByName(auc)


_H = hash_sql("tx_id")
FOLD_SCORES_SQL = f"""folds AS (
  SELECT tx_id, CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_H}, tx_id) - 1) % {N_FOLDS} AS INTEGER) AS fold
  FROM tx),
sf AS (SELECT s.*, f.fold FROM scores s JOIN folds f USING (tx_id)),
conf AS (
  SELECT model, fold,
         SUM(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,
         SUM(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
         SUM(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn
  FROM sf GROUP BY model, fold),
per AS (SELECT model, fold, score, SUM(label) AS pos, SUM(1 - label) AS neg FROM sf GROUP BY model, fold, score),
cum AS (
  SELECT *, SUM(pos) OVER (PARTITION BY model, fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tpc,
         SUM(pos) OVER (PARTITION BY model, fold) AS n_pos, SUM(neg) OVER (PARTITION BY model, fold) AS n_neg
  FROM per),
fs AS (
  SELECT 'f1' AS metric, model, fold, {S.ratio('2.0 * tp', '2.0 * tp + fp + fn')} AS score FROM conf
  UNION ALL
  SELECT 'roc_auc', model, fold,
         CAST(SUM(CAST(neg AS HUGEINT) * (2 * tpc - pos)) AS DOUBLE) / (2.0 * MAX(n_pos) * MAX(n_neg))
  FROM cum GROUP BY model, fold)"""
_ORD = "CASE model WHEN " + " WHEN ".join(f"'{m}' THEN {i}" for i, m in enumerate(SCORE_MODELS)) + " END"
PAIRS_SQL = f"""ords AS (SELECT DISTINCT model, {_ORD} AS ord FROM fs),
diffs AS (
  SELECT a.metric, a.model AS model_a, b.model AS model_b, a.fold, a.score - b.score AS diff
  FROM fs a JOIN fs b ON a.metric = b.metric AND a.fold = b.fold
  JOIN ords oa ON oa.model = a.model JOIN ords ob ON ob.model = b.model
  WHERE oa.ord < ob.ord),
dstat AS (
  SELECT metric, model_a, model_b, COUNT(*) AS n, avg(diff) AS mean_diff, var_samp(diff) AS var_diff
  FROM diffs GROUP BY metric, model_a, model_b)"""


def _tt_sql(corrected: bool) -> str:
    factor = f"(1.0 / n + {RATIO!r})" if corrected else "(1.0 / n)"
    t = f"(CASE WHEN var_diff = 0 THEN 0.0 ELSE mean_diff / sqrt({factor} * var_diff) END)"
    p = f"(CASE WHEN var_diff = 0 THEN 1.0 ELSE {D.t_two_sided_p_sql(t, N_FOLDS - 1)} END)"
    return f"tt AS (SELECT metric, model_a, model_b, n, mean_diff, var_diff, {t} AS t_statistic, {p} AS p_value FROM dstat)"


def _ttests(spark, sf_dir, corrected: bool) -> DataFrame:
    fs = cv_fold_scores(spark, sf_dir)
    diffs = ST.paired_differences(fs, SCORE_MODELS)
    return ST.paired_ttests(diffs, test_train_ratio=RATIO if corrected else None)


def _tt_out(df: DataFrame) -> DataFrame:
    return df.select("metric", "model_a", "model_b", r6("mean_diff").alias("mean_diff"),
                     r6("t_statistic").alias("t_statistic"), r6("p_value").alias("p_value"))


_TT_BODY = (f"SELECT metric, model_a, model_b, {S.r6('mean_diff')} AS mean_diff, "
            f"{S.r6('t_statistic')} AS t_statistic, {S.r6('p_value')} AS p_value FROM tt")


def cv_fold_scores_df(spark, sf_dir):
    return cv_fold_scores(spark, sf_dir).select("metric", "model", "fold", r6("score").alias("score"))


register("cv_fold_scores", "SRC-2,SMP-2,EVL-3", with_ctes(
    TX_SQL, SCORES_SQL, FOLD_SCORES_SQL,
    body=f"SELECT metric, model, fold, {S.r6('score')} AS score FROM fs"))(cv_fold_scores_df)

register("paired_ttest", "TST-2,TST-3,JN-2,AGG-10", with_ctes(
    TX_SQL, SCORES_SQL, FOLD_SCORES_SQL, PAIRS_SQL, _tt_sql(False), body=_TT_BODY))(
    lambda spark, sf_dir: _tt_out(_ttests(spark, sf_dir, False)))

register("corrected_ttest", "TST-1,TST-3,JN-2,AGG-10", with_ctes(
    TX_SQL, SCORES_SQL, FOLD_SCORES_SQL, PAIRS_SQL, _tt_sql(True), body=_TT_BODY))(
    lambda spark, sf_dir: _tt_out(_ttests(spark, sf_dir, True)))


def ttest_matrix_df(spark, sf_dir):
    m = ST.ttest_matrix(_ttests(spark, sf_dir, True))
    return m.select("metric", "model_a", "model_b", r6("t_statistic").alias("t_statistic"),
                    r6("p_value").alias("p_value"), r6("t_shown").alias("t_shown"))


register("ttest_matrix", "JN-3,JN-4", with_ctes(
    TX_SQL, SCORES_SQL, FOLD_SCORES_SQL, PAIRS_SQL, _tt_sql(True), """mat AS (
  SELECT metric, model_a, model_b, t_statistic, p_value FROM tt
  UNION ALL SELECT metric, model_b, model_a, -t_statistic, p_value FROM tt
  UNION ALL SELECT DISTINCT metric, model, model, 0.0, 1.0 FROM (
      SELECT metric, model_a AS model FROM tt UNION SELECT metric, model_b FROM tt))""",
    body=f"""SELECT metric, model_a, model_b, {S.r6('t_statistic')} AS t_statistic, {S.r6('p_value')} AS p_value,
       {S.r6('CASE WHEN p_value < 0.05 THEN t_statistic END')} AS t_shown FROM mat"""))(ttest_matrix_df)


# ---- normality ----------------------------------------------------------------

def _sw_sql(src: str, group: list[str], value: str) -> str:
    """Shapiro-Wilk over ``src`` as SQL CTEs ending in ``sw``."""
    g = ", ".join(group)
    return f"""swb AS (SELECT {g}, CAST({value} AS DOUBLE) AS x FROM {src} WHERE {value} IS NOT NULL),
swr AS (
  SELECT *, {D.norm_ppf_sql('(i - 0.375) / (n + 0.25)')} AS m FROM (
    SELECT {g}, x, ROW_NUMBER() OVER (PARTITION BY {g} ORDER BY x) AS i, COUNT(*) OVER (PARTITION BY {g}) AS n
    FROM swb)),
swa AS (
  SELECT {g}, MAX(n) AS n, SUM(m * m) AS mm, SUM(m * x) AS s_all,
         MAX(CASE WHEN i = 1 THEN x END) AS x1, MAX(CASE WHEN i = 2 THEN x END) AS x2,
         MAX(CASE WHEN i = n - 1 THEN x END) AS xn1, MAX(CASE WHEN i = n THEN x END) AS xn,
         MAX(CASE WHEN i = 1 THEN m END) AS m1, MAX(CASE WHEN i = 2 THEN m END) AS m2,
         MAX(CASE WHEN i = n - 1 THEN m END) AS mn1, MAX(CASE WHEN i = n THEN m END) AS mn,
         var_pop(x) * COUNT(*) AS ss
  FROM swr GROUP BY {g}),
swf AS (SELECT * FROM swa WHERE n >= 3),
{ST.stages_sql("swf", ST.shapiro_sql(), "sw")}"""


def shapiro_wilk_df(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer")
    sw = ST.shapiro_wilk(cust, ["c_mktsegment"], "c_acctbal")
    return sw.select("c_mktsegment", "n", r6("w").alias("w"), r6("p_value").alias("p_value"), "normal")


register("shapiro_wilk", "TST-4", with_ctes(
    _sw_sql("customer", ["c_mktsegment"], "c_acctbal"),
    body=f"SELECT c_mktsegment, n, {S.r6('w')} AS w, {S.r6('p_value')} AS p_value, p_value > 0.05 AS normal FROM sw"))(
    shapiro_wilk_df)


def fold_normality_df(spark, sf_dir):
    """Shapiro-Wilk of each model's fold scores and of each pair's differences,
    ordered by p (ascending)."""
    fs = cv_fold_scores(spark, sf_dir)
    per_model = ST.shapiro_wilk(fs.withColumn("model_b", F.lit("")).withColumnRenamed("model", "model_a"),
                                ["metric", "model_a", "model_b"], "score")
    diffs = ST.paired_differences(fs, SCORE_MODELS)
    per_pair = ST.shapiro_wilk(diffs, ["metric", "model_a", "model_b"], "diff")
    out = per_model.unionByName(per_pair)
    return out.select("metric", "model_a", "model_b", "n", r6("w").alias("w"),
                      r6("p_value").alias("p_value"), "normal").orderBy("metric", "p_value")


register("fold_normality", "TST-4,SRT-4,JN-2", with_ctes(
    TX_SQL, SCORES_SQL, FOLD_SCORES_SQL, PAIRS_SQL,
    """src AS (SELECT metric, model AS model_a, '' AS model_b, score AS v FROM fs
  UNION ALL SELECT metric, model_a, model_b, diff FROM diffs)""",
    _sw_sql("src", ["metric", "model_a", "model_b"], "v"),
    body=f"""SELECT metric, model_a, model_b, n, {S.r6('w')} AS w, {S.r6('p_value')} AS p_value,
       p_value > 0.05 AS normal FROM sw ORDER BY metric, p_value"""))(fold_normality_df)


def _qq_sql() -> str:
    q = ("CASE WHEN rnk = n THEN pow(0.5, 1.0 / n) WHEN rnk = 1 THEN 1.0 - pow(0.5, 1.0 / n) "
         "ELSE (rnk - 0.3175) / (n + 0.365) END")
    return f"""qq AS (
  SELECT c_mktsegment, rnk, {D.norm_ppf_sql(q)} AS theoretical, x AS sample FROM (
    SELECT c_mktsegment, CAST(c_acctbal AS DOUBLE) AS x,
           ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) AS rnk,
           COUNT(*) OVER (PARTITION BY c_mktsegment) AS n
    FROM customer WHERE c_acctbal IS NOT NULL))"""


def qq_points_df(spark, sf_dir):
    pts = ST.qq_points(read_table(spark, sf_dir, "customer"), ["c_mktsegment"], "c_acctbal")
    return pts.select("c_mktsegment", F.col("rank").alias("rnk"), r6("theoretical").alias("theoretical"),
                      r6("sample").alias("sample"))


register("qq_points", "TST-5", with_ctes(
    _qq_sql(), body=f"SELECT c_mktsegment, rnk, {S.r6('theoretical')} AS theoretical, {S.r6('sample')} AS sample FROM qq"))(
    qq_points_df)


def qq_line_df(spark, sf_dir):
    pts = ST.qq_points(read_table(spark, sf_dir, "customer"), ["c_mktsegment"], "c_acctbal")
    line = ST.qq_line(pts, ["c_mktsegment"])
    return line.select("c_mktsegment", r6("slope").alias("slope"), r6("intercept").alias("intercept"),
                       r6("r").alias("r"))


register("qq_line", "TST-5", with_ctes(
    _qq_sql(), body=f"""SELECT c_mktsegment, {S.r6('regr_slope(sample, theoretical)')} AS slope,
       {S.r6('regr_intercept(sample, theoretical)')} AS intercept, {S.r6('corr(theoretical, sample)')} AS r
FROM qq GROUP BY c_mktsegment"""))(qq_line_df)


def fold_scores_csv_roundtrip_df(spark, sf_dir):
    """Fold scores written in the column-per-model CSV layout (one file per
    metric, one row per fold) and read back into long rows."""
    from txscore.sources import io as IO
    fs = cv_fold_scores(spark, sf_dir)
    wide = IO.long_to_wide(fs, ["metric", "fold"], "model", "score", SCORE_MODELS)
    path = IO.shared_path(spark, "fold_scores")
    IO.write_table(wide, path, fmt="csv", partition_by=["metric"])
    schema = "fold int, " + ", ".join(f"{m} double" for m in SCORE_MODELS) + ", metric string"
    back = spark.read.schema(schema).option("header", True).csv(path)
    long = IO.wide_to_long(back, ["metric", "fold"], SCORE_MODELS, "model", "score")
    return long.select("metric", "model", "fold", r6("score").alias("score"))


register("fold_scores_csv_roundtrip", "SRC-2,SRC-1,SNK-1", CATALOG["cv_fold_scores"].sql)(
    fold_scores_csv_roundtrip_df)
