"""Gaussian naive Bayes: fit is one grouped aggregate, scoring one projection.

Per class: prior n_c / n and, per feature, mean and population variance.
Every variance is widened by ``var_smoothing`` x (largest per-feature variance
over all training rows). The fitted table has 2 x d numbers; they become
literals of the scoring expression, so scoring needs no join and no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.operators.ordered import join_small

VAR_SMOOTHING = 1e-05   # fixed value of the tuned model


def gnb_fit_table(train: DataFrame, features: Sequence[str], label: str = "label",
                  var_smoothing: float = VAR_SMOOTHING) -> DataFrame:
    """(label, feature, prior, mean, var) with smoothed variances."""
    feats = list(features)
    overall = train.agg(*[F.var_pop(c).alias(c) for c in feats]).first()   # d scalars
    eps = var_smoothing * max(float(overall[c]) for c in feats)
    per = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"),
                                   *[F.avg(c).alias(f"m__{c}") for c in feats],
                                   *[F.var_pop(c).alias(f"v__{c}") for c in feats])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m__{c}").alias("mean"),
                                         F.col(f"v__{c}").alias("v")) for c in feats]))
    total = F.sum("n_c").over(Window.partitionBy())   # one row per class
    with_prior = per.withColumn("prior", F.col("n_c") / total)
    return (with_prior.select(F.col(label).alias("label"), "prior", stack.alias("s"))
               .select("label", F.col("s.feature").alias("feature"), "prior",
                       F.col("s.mean").alias("mean"), (F.col("s.v") + F.lit(eps)).alias("var")))


@dataclass
class GaussianNBModel:
    features: list[str]
    params: dict[int, dict]   # class -> {"prior": p, "mean": {f: m}, "var": {f: v}}

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str], label: str = "label",
            var_smoothing: float = VAR_SMOOTHING) -> "GaussianNBModel":
        return GaussianNBModel.from_table(gnb_fit_table(train, features, label, var_smoothing), features)

    @staticmethod
    def from_table(table: DataFrame, features: Sequence[str]) -> "GaussianNBModel":
        """Model from a (label, feature, prior, mean, var) table, e.g. a reloaded one."""
        rows = table.collect()  # 2 x d rows
        params: dict[int, dict] = {}
        for r in rows:
            p = params.setdefault(int(r["label"]), {"prior": r["prior"], "mean": {}, "var": {}})
            p["mean"][r["feature"]] = r["mean"]
            p["var"][r["feature"]] = r["var"]
        return GaussianNBModel(list(features), params)

    def joint_log_likelihood(self, c: int, cols: dict[str, Column] | None = None) -> Column:
        """Log of P(class) P(x | class); minus infinity for a class without training rows."""
        if c not in self.params:
            return F.lit(-math.inf)
        p = self.params[c]
        const = math.log(p["prior"]) - 0.5 * sum(math.log(2.0 * math.pi * p["var"][f]) for f in self.features)
        quad = None
        for f in self.features:
            x = cols[f] if cols else F.col(f)
            t = (x - F.lit(p["mean"][f])) ** 2 / F.lit(p["var"][f])
            quad = t if quad is None else quad + t
        return F.lit(const) - F.lit(0.5) * quad

    def score_expr(self, cols: dict[str, Column] | None = None) -> Column:
        """P(class 1 | x) as a Column, over the given feature Columns if any (a scoring
        function for the explainers)."""
        gap = self.joint_log_likelihood(0, cols) - self.joint_log_likelihood(1, cols)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(gap))

    def predictor(self):
        """P(class 1) as a function of a feature matrix."""
        params = [(math.log(p["prior"]), np.array([p["mean"][f] for f in self.features]),
                   np.array([p["var"][f] for f in self.features])) if (p := self.params.get(c)) else None
                  for c in (0, 1)]

        def predict(x: np.ndarray) -> np.ndarray:
            log_joint = [np.full(len(x), -np.inf) if p is None else
                         p[0] - 0.5 * np.log(2 * np.pi * p[2]).sum() - 0.5 * ((x - p[1]) ** 2 / p[2]).sum(1)
                         for p in params]
            with np.errstate(over="ignore"):
                return 1 / (1 + np.exp(log_joint[0] - log_joint[1]))

        return predict

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``score`` = P(class 1 | x) and ``pred`` (1 iff P(1) > 0.5)."""
        return df.withColumn("score", self.score_expr()).withColumn("pred", (F.col("score") > 0.5).cast("int"))


def gnb_fit_grouped(train: DataFrame, features: Sequence[str], group: str, smoothing: dict[str, float],
                    label: str = "label") -> DataFrame:
    """One row for each group (e.g. the training part of a fold) and candidate (name: var_smoothing)
    with both classes' prior, means and smoothed variances as columns ``{c}_prior``, ``{c}_m__f``,
    ``{c}_v__f``, null for a class without rows: all groups are fitted by two grouped aggregates."""
    feats = list(features)
    widest = F.array_max(F.array(*[F.var_pop(c) for c in feats]))
    top = train.groupBy(group).agg(widest.alias("_top"), F.count(F.lit(1)).alias("_n"))

    def of(c: int, value: Column) -> Column:
        return F.when(F.col(label) == c, value)

    per = train.groupBy(group).agg(
        *[F.count(of(c, F.lit(1))).alias(f"_n{c}") for c in (0, 1)],
        *[F.avg(of(c, F.col(f))).alias(f"{c}_m__{f}") for c in (0, 1) for f in feats],
        *[F.var_pop(of(c, F.col(f))).alias(f"_v{c}__{f}") for c in (0, 1) for f in feats])
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("candidate"), F.lit(float(v)).alias("_vs"))
                                for n, v in smoothing.items()]))
    per = per.join(top, group).select("*", names.alias("_s"))   # groups x candidates rows
    return per.select(
        group, F.col("_s.candidate").alias("candidate"),
        *[F.when(F.col(f"_n{c}") > 0, F.col(f"_n{c}") / F.col("_n")).alias(f"{c}_prior") for c in (0, 1)],
        *[F.col(f"{c}_m__{f}") for c in (0, 1) for f in feats],
        *[(F.col(f"_v{c}__{f}") + F.col("_s._vs") * F.col("_top")).alias(f"{c}_v__{f}") for c in (0, 1) for f in feats])


def gnb_transform_grouped(df: DataFrame, params: DataFrame, features: Sequence[str], group: str) -> DataFrame:
    """Every row scored with the parameters of its group by each candidate (a join with the small
    parameter table); adds ``candidate``, ``score`` and ``pred``."""
    j = join_small(df, params, [group])

    def jll(c: int) -> Column:
        out = F.log(F.col(f"{c}_prior"))
        for f in features:
            v = F.col(f"{c}_v__{f}")
            out = out - F.lit(0.5) * F.log(F.lit(2.0 * math.pi) * v) \
                - F.lit(0.5) * (F.col(f) - F.col(f"{c}_m__{f}")) ** 2 / v
        return F.when(F.col(f"{c}_prior").isNull(), F.lit(-math.inf)).otherwise(out)

    score = F.lit(1.0) / (F.lit(1.0) + F.exp(jll(0) - jll(1)))
    return j.select(*df.columns, "candidate", score.alias("score")) \
        .withColumn("pred", (F.col("score") > 0.5).cast("int"))
