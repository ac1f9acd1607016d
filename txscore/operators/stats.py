"""Model comparison statistics over long fold-score tables.

Input tables are long: ``(…group…, model, fold, score)``. Model pairs come from
the (configured, short) model list as an explicit pairs table joined on equal
keys, never from a self-join over data rows. Everything else is grouped
aggregation plus closed-form Column math:

* paired differences, mean and sample variance per pair (AGG-10),
* corrected resampled t (Nadeau & Bengio) and the plain paired t; two-sided p
  from the Student-t series (``distributions``),
* Shapiro-Wilk W and p (Royston 1995 approximation, the AS R94 algorithm) for
  any number of groups of any size: ranks come from ``ordered_row_number``
  and the coefficients from n and sum(m_i^2), so no group is ever collected,
* Q-Q points (Filliben medians) and the least-squares line.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.functions import distributions as D
from txscore.operators.ordered import join_small, value_ranks

# Royston (1995) / AS R94 polynomial coefficients (ascending powers).
SW_C1 = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
SW_C2 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SW_C3 = [0.5440, -0.39978, 0.025054, -0.0006714]
SW_C4 = [1.3822, -0.77857, 0.062767, -0.0020322]
SW_C5 = [-1.5861, -0.31082, -0.083751, 0.0038915]
SW_C6 = [-0.4803, -0.082676, 0.0030302]
SW_G = [-2.273, 0.459]
SW_SMALL = 1e-99
SIGNIFICANCE = 0.05


def model_pairs(spark, models: Sequence[str]) -> DataFrame:
    """Unordered pairs (model_a, model_b) in list order: a before b."""
    rows = [(a, b) for a, b in combinations(list(models), 2)]
    return spark.createDataFrame(rows, "model_a string, model_b string")


def paired_differences(scores: DataFrame, models: Sequence[str], by: Sequence[str] = ("metric",),
                       model: str = "model", fold: str = "fold", score: str = "score") -> DataFrame:
    """(by…, model_a, model_b, fold, diff = score_a - score_b)."""
    by = list(by)
    pairs = model_pairs(scores.sparkSession, models)
    a = scores.select(*by, F.col(model).alias("model_a"), F.col(fold).alias("fold"),
                      F.col(score).alias("score_a"))
    b = scores.select(*by, F.col(model).alias("model_b"), F.col(fold).alias("fold"),
                      F.col(score).alias("score_b"))
    pa = a.join(F.broadcast(pairs), "model_a")      # pairs: C(models, 2) rows, config-sized
    return (pa.join(b, by + ["model_b", "fold"])
              .select(*by, "model_a", "model_b", "fold",
                      (F.col("score_a") - F.col("score_b")).alias("diff")))


def paired_ttests(diffs: DataFrame, by: Sequence[str] = ("metric",),
                  test_train_ratio: float | None = None) -> DataFrame:
    """t and two-sided p per pair. ``test_train_ratio`` = n_test / n_train turns
    on the corrected resampled variance factor (1/n + ratio); None -> plain 1/n.
    A zero variance of the differences gives (t, p) = (0, 1)."""
    by = list(by)
    g = diffs.groupBy(*by, "model_a", "model_b").agg(
        F.avg("diff").alias("mean_diff"), F.var_samp("diff").alias("var_diff"),
        F.count(F.lit(1)).alias("n"))
    n = F.col("n").cast("double")
    factor = F.lit(1.0) / n
    if test_train_ratio is not None:
        factor = factor + F.lit(float(test_train_ratio))
    t = F.col("mean_diff") / F.sqrt(factor * F.col("var_diff"))
    zero = F.col("var_diff") == 0
    t = F.when(zero, F.lit(0.0)).otherwise(t)
    p = F.when(zero, F.lit(1.0)).otherwise(D.t_two_sided_p(t, F.col("n") - 1))
    return g.select(*by, "model_a", "model_b", "n", "mean_diff", "var_diff",
                    t.alias("t_statistic"), p.alias("p_value"))


def ttest_matrix(tests: DataFrame, by: Sequence[str] = ("metric",)) -> DataFrame:
    """Full model x model matrix in long form: p symmetric, t antisymmetric,
    diagonal (t, p) = (0, 1); ``t_shown`` only where p < 0.05."""
    by = list(by)
    fwd = tests.select(*by, "model_a", "model_b", "t_statistic", "p_value")
    rev = tests.select(*by, F.col("model_b").alias("model_a"), F.col("model_a").alias("model_b"),
                       (-F.col("t_statistic")).alias("t_statistic"), "p_value")
    # diagonal: every model present in a group meets itself
    present = fwd.select(*by, "model_a").unionByName(
        fwd.select(*by, F.col("model_b").alias("model_a"))).distinct()
    diag = present.select(*by, "model_a", F.col("model_a").alias("model_b"),
                          F.lit(0.0).alias("t_statistic"), F.lit(1.0).alias("p_value"))
    full = fwd.unionByName(rev).unionByName(diag)
    return full.withColumn("t_shown", F.when(F.col("p_value") < SIGNIFICANCE, F.col("t_statistic")))


# --- Shapiro-Wilk -------------------------------------------------------------

def _poly_sql(coefs: Sequence[float], x: str) -> str:
    out = repr(float(coefs[-1]))
    for c in reversed(coefs[:-1]):
        out = f"({out} * {x} + {float(c)!r})"
    return out


def shapiro_sql(n="n", mm="mm", s_all="s_all", x1="x1", x2="x2", xn1="xn1", xn="xn",
                m1="m1", m2="m2", mn1="mn1", mn="mn", ss="ss") -> list[dict[str, str]]:
    """Shapiro-Wilk as staged SQL projections over per-group aggregates of the
    ranked sample (n, sum m_i^2, sum m_i*x_(i), the two lowest / highest order
    statistics and their normal scores, sum of squared deviations).

    Each stage is a dict name -> SQL text that may use the names of earlier
    stages; applying them in order keeps every expression small.
    """
    nd = f"CAST({n} AS DOUBLE)"
    u = f"(1.0 / sqrt({nd}))"
    st1 = {"a_n": f"(-{m1} / sqrt({mm}) + {_poly_sql(SW_C1, u)})",
           "a_n1": f"(-{m2} / sqrt({mm}) + {_poly_sql(SW_C2, u)})"}
    fac_big = f"sqrt(({mm} - 2.0 * {m1} * {m1} - 2.0 * {m2} * {m2}) / (1.0 - 2.0 * a_n * a_n - 2.0 * a_n1 * a_n1))"
    fac_small = f"sqrt(({mm} - 2.0 * {m1} * {m1}) / (1.0 - 2.0 * a_n * a_n))"
    big = (f"(({s_all} - {m1} * {x1} - {mn} * {xn} - {m2} * {x2} - {mn1} * {xn1}) / {fac_big}"
           f" + a_n * ({xn} - {x1}) + a_n1 * ({xn1} - {x2}))")
    small = f"(({s_all} - {m1} * {x1} - {mn} * {xn}) / {fac_small} + a_n * ({xn} - {x1}))"
    three = f"(sqrt(0.5) * ({xn} - {x1}))"
    st2 = {"lin": f"(CASE WHEN {n} = 3 THEN {three} WHEN {n} > 5 THEN {big} ELSE {small} END)"}
    st3 = {"w": f"least(CASE WHEN {ss} = 0 THEN NULL ELSE (lin * lin) / {ss} END, 1.0)"}
    st4 = {"y": "(CASE WHEN w < 1.0 THEN ln(1.0 - w) END)"}
    gamma = _poly_sql(SW_G, nd)
    m_small = _poly_sql(SW_C3, nd)
    s_small = f"exp({_poly_sql(SW_C4, nd)})"
    ln_n = f"ln({nd})"
    m_big = _poly_sql(SW_C5, ln_n)
    s_big = f"exp({_poly_sql(SW_C6, ln_n)})"
    p3 = "greatest(6.0 / pi() * (asin(sqrt(w)) - asin(sqrt(0.75))), 0.0)"
    st5 = {"z": (f"(CASE WHEN {n} <= 11 AND y < {gamma} THEN ((-ln({gamma} - y)) - {m_small}) / {s_small} "
                 f"WHEN {n} > 11 THEN (y - {m_big}) / {s_big} END)")}
    p = (f"(CASE WHEN w IS NULL THEN NULL WHEN w >= 1.0 THEN 1.0 WHEN {n} = 3 THEN {p3} "
         f"WHEN {n} <= 11 AND y >= {gamma} THEN {SW_SMALL!r} ELSE {D.norm_sf_sql('z')} END)")
    return [st1, st2, st3, st4, st5, {"p_value": p}]


def apply_stages(df: DataFrame, stages: list[dict[str, str]]) -> DataFrame:
    for st in stages:
        df = df.select("*", *[F.expr(e).alias(k) for k, e in st.items()])
    return df


def stages_sql(src: str, stages: list[dict[str, str]], name: str) -> str:
    """Nest the staged projections as SQL subqueries over ``src``."""
    q = f"SELECT * FROM {src}"
    for st in stages:
        q = f"SELECT *, {', '.join(f'{e} AS {k}' for k, e in st.items())} FROM ({q})"
    return f"{name} AS ({q})"


def shapiro_wilk(df: DataFrame, group_cols: Sequence[str], value: str) -> DataFrame:
    """(group…, n, w, p_value, normal) for every group with n >= 3."""
    g = list(group_cols)
    base = df.select(*g, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    sizes = base.groupBy(*g).agg(F.count(F.lit(1)).alias("n"),
                                 (F.var_pop("_x") * F.count(F.lit(1))).alias("ss"))
    ranked = value_ranks(base, g, "_x", "_i")
    if not g:
        raise ValueError("shapiro_wilk needs at least one group column")
    ranked = join_small(ranked, sizes.select(*g, "n"), g)
    ranked = ranked.withColumn("_p", (F.col("_i") - F.lit(0.375)) / (F.col("n") + F.lit(0.25)))
    ranked = ranked.withColumn("_m", F.expr(D.norm_ppf_sql("_p")))
    i, n, x, m = F.col("_i"), F.col("n"), F.col("_x"), F.col("_m")
    at = lambda pos, c: F.max(F.when(i == pos, c))
    agg = ranked.groupBy(*g).agg(
        F.sum(m * m).alias("mm"), F.sum(m * x).alias("s_all"),
        at(1, x).alias("x1"), at(2, x).alias("x2"), at(n - 1, x).alias("xn1"), at(n, x).alias("xn"),
        at(1, m).alias("m1"), at(2, m).alias("m2"), at(n - 1, m).alias("mn1"), at(n, m).alias("mn"))
    full = agg.join(sizes, g)
    full = full.where(F.col("n") >= 3)
    out = apply_stages(full, shapiro_sql()).select(*g, "n", "w", "p_value")
    return out.withColumn("normal", F.col("p_value") > F.lit(SIGNIFICANCE))


def qq_points(df: DataFrame, group_cols: Sequence[str], value: str) -> DataFrame:
    """(group…, rank, theoretical, sample): ordered values against normal
    quantiles of the Filliben order-statistic medians."""
    g = list(group_cols)
    base = df.select(*g, F.col(value).cast("double").alias("sample")).where(F.col("sample").isNotNull())
    sizes = base.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    ranked = join_small(value_ranks(base, g, "sample", "rank"), sizes, g)
    n = F.col("_n").cast("double")
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    med = (F.when(F.col("rank") == F.col("_n"), last)
            .when(F.col("rank") == 1, F.lit(1.0) - last)
            .otherwise((F.col("rank") - F.lit(0.3175)) / (n + F.lit(0.365))))
    return (ranked.withColumn("_q", med)
            .select(*g, "rank", F.expr(D.norm_ppf_sql("_q")).alias("theoretical"), "sample"))


def qq_line(points: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Least-squares line of sample on theoretical quantiles and its r."""
    return points.groupBy(*group_cols).agg(
        F.regr_slope("sample", "theoretical").alias("slope"),
        F.regr_intercept("sample", "theoretical").alias("intercept"),
        F.corr("theoretical", "sample").alias("r"))
