"""SAMME boosting of stumps over a table of weighted cells.

Equal binned rows of a class always weigh the same, so they are one cell with one weight
(``growth.cell_table``). A round finds the stump with the largest Gini gain of the weights, lets
both sides vote for their heavier class, and moves weight to the cells that it gets wrong:
with error e the stump's weight is rate * ln((1 - e) / e), and the weights of wrong cells are
multiplied by its exponential. Rounds end early without an error or at chance.

``rounds`` runs each round as one aggregate over the cells, whatever their number: sums by
(feature, bin, class), running sums over the bins, a grouped maximum, and a projection of the new
weights. ``fit_cells`` does the same rounds for a bounded cell table inside one task, where
thousands of rounds of many fits run side by side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rounds after which the weights are cut from their lineage.
CUT_ROUNDS = 8


def class_cells(cells: DataFrame) -> DataFrame:
    """(bins as an array, y, w) of a cell table with columns bins (array of int), n, pos: a cell for each
    class, of weights that sum to one."""
    two = F.explode(F.array(F.struct(F.lit(1).alias("y"), F.col("pos").alias("w")),
                            F.struct(F.lit(0).alias("y"), (F.col("n") - F.col("pos")).alias("w"))))
    out = cells.select("bins", two.alias("c")).select("bins", "c.y", "c.w").where("w > 0")
    total = out.agg(F.sum("w")).first()[0]
    return out.withColumn("w", F.col("w") / F.lit(float(total or 1.0)))


def best_stump(weighted: DataFrame) -> dict | None:
    """feature, bin (the last one left), left and right (the classes voted for) and error."""
    flat = weighted.select("y", "w", F.posexplode("bins").alias("feature", "bin"))
    sums = flat.groupBy("feature", "bin").agg(
        F.sum("w").alias("n"), F.sum(F.when(F.col("y") == 1, F.col("w")).otherwise(0.0)).alias("pos"))
    by = Window.partitionBy("feature")  # the bins of a feature
    left = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.select("feature", "bin", *[F.sum(c).over(w).alias(f"{s}{c}") for c in ("n", "pos")
                                           for s, w in (("l", left), ("t", by))])
    sums = sums.withColumns({"rn": F.col("tn") - F.col("ln"), "rpos": F.col("tpos") - F.col("lpos")})
    cuts = sums.withColumn("last", F.max("bin").over(by)).where("bin < last")
    gain = F.expr("lpos * lpos / ln + rpos * rpos / rn - tpos * tpos / tn")
    votes = {s: (F.col(f"{s}pos") > F.col(f"{s}n") - F.col(f"{s}pos")).cast("int") for s in "lr"}
    wrong = sum((F.when(votes[s] == 1, F.col(f"{s}n") - F.col(f"{s}pos")).otherwise(F.col(f"{s}pos")) for s in "lr"),
                F.lit(0.0))
    row = cuts.select("feature", "bin", votes["l"].alias("left"), votes["r"].alias("right"),
                      (wrong / F.col("tn")).alias("error"), F.round(gain, 12).alias("gain")) \
        .orderBy(F.col("gain").desc(), "feature", "bin").first()
    return row.asDict() if row else None


def rounds(cells: DataFrame, n_rounds: int, learning_rate: float = 1.0) -> list[dict]:
    """The stumps of the first rounds with their weights (``alpha``), in order."""
    weighted, out = class_cells(cells), []
    for i in range(n_rounds):
        stump = best_stump(weighted)
        if stump is None or stump["error"] >= 0.5:
            break
        if stump["error"] <= 0:
            out.append(stump | {"alpha": 1.0})
            break
        alpha = learning_rate * math.log((1 - stump["error"]) / stump["error"])
        out.append(stump | {"alpha": alpha})
        vote = F.when(F.col("bins")[stump["feature"]] <= stump["bin"], F.lit(stump["left"])).otherwise(
            F.lit(stump["right"]))
        grown = F.when(vote != F.col("y"), F.col("w") * F.lit(math.exp(alpha))).otherwise(F.col("w"))
        # the new weights sum to 1 - e + e exp(alpha)
        whole = 1 - stump["error"] + stump["error"] * math.exp(alpha)
        weighted = weighted.withColumn("w", grown / F.lit(whole))
        if (i + 1) % CUT_ROUNDS == 0:
            weighted = weighted.checkpoint()
    return out


def newton_splits(cells: DataFrame, weights: Sequence[float], lam: float = 1.0) -> DataFrame:
    """The first boosting round of the logistic loss for several weights of the positive class:
    (weight, g, h, leaf, feature, bin, gain), where leaf is the step without a split and the rest
    the split with the largest gain. ``cells``: bins (array of int), n, pos."""
    each = F.explode(F.array(*[F.lit(float(w)) for w in weights])).alias("weight")
    rows = cells.select(each, "bins", "n", "pos").withColumns({
        "g": (F.col("weight") * F.col("pos") - (F.col("n") - F.col("pos"))) * F.lit(0.5),
        "h": (F.col("weight") * F.col("pos") + (F.col("n") - F.col("pos"))) * F.lit(0.25)})
    sums = (rows.select("weight", "g", "h", F.posexplode("bins").alias("feature", "bin"))
            .groupBy("weight", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")))
    by = Window.partitionBy("weight", "feature")
    left = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.select("weight", "feature", "bin", F.max("bin").over(by).alias("last"), *[
        F.sum(c).over(w).alias(f"{s}{c}") for c in ("g", "h") for s, w in (("l", left), ("t", by))])
    gain = F.expr(f"lg * lg / (lh + {lam!r}D) + (tg - lg) * (tg - lg) / (th - lh + {lam!r}D)"
                  f" - tg * tg / (th + {lam!r}D)")
    cuts = sums.where("bin < last").withColumn("gain", F.round(gain, 9))
    best = F.max_by(F.struct(F.col("tg").alias("g"), F.col("th").alias("h"), "feature", "bin", "gain"),
                    F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")))
    return cuts.groupBy("weight").agg(best.alias("s")).select(
        "weight", "s.g", "s.h", (F.col("s.g") / (F.col("s.h") + F.lit(lam))).alias("leaf"), "s.feature", "s.bin", "s.gain")


def fit_cells(bins: np.ndarray, y: np.ndarray, w: np.ndarray, n_rounds: int,
              learning_rate: float = 1.0) -> list[tuple[int, int, float, float, float]]:
    """(feature, bin, left vote, right vote, alpha) of every round over cells (``bins``: cells x features,
    votes +1 or -1)."""
    k, d = bins.shape
    width = int(bins.max(initial=0)) + 1
    at = (bins + np.arange(d) * width).ravel()
    last = bins.max(axis=0, initial=0)
    closed = np.arange(width) >= last[:, None]
    w, sign, out = w / w.sum(), np.where(y == 1, 1.0, -1.0), []
    for _ in range(n_rounds):
        n = np.bincount(at, np.repeat(w, d), d * width).reshape(d, width).cumsum(1)
        p = np.bincount(at, np.repeat(w * (y == 1), d), d * width).reshape(d, width).cumsum(1)
        tn, tp = n[:, -1:], p[:, -1:]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = p * p / n + (tp - p) ** 2 / (tn - n) - tp * tp / tn
        gain = np.where(closed | (n <= 0), -np.inf, np.round(gain, 12))
        f, b = divmod(int(gain.argmax()), width)
        if not np.isfinite(gain[f, b]):
            break
        left, right = (1.0 if 2 * a > c else -1.0 for a, c in (
            (p[f, b], n[f, b]), (tp[f, 0] - p[f, b], tn[f, 0] - n[f, b])))
        wrong = np.where(bins[:, f] <= b, left, right) != sign
        error = float(w[wrong].sum())
        if error >= 0.5:
            break
        alpha = learning_rate * math.log((1 - error) / error) if error > 0 else 1.0
        out.append((f, b, left, right, alpha))
        if error <= 0:
            break
        w = np.where(wrong, w * math.exp(alpha), w)
        w /= w.sum()
    return out


def stumps(found: Sequence[tuple], cuts: Sequence[np.ndarray]) -> list[dict[str, np.ndarray]]:
    """Two-leaf trees of the rounds, with the cuts of the bins as values."""
    return [{"feature": np.array([f, -1, -1]), "cut": np.array([cuts[f][b], 0.0, 0.0]),
             "left": np.array([1, -1, -1]), "right": np.array([2, -1, -1]),
             "value": np.array([0.0, left, right]), "gain": np.array([alpha, 0.0, 0.0])}
            for f, b, left, right, alpha in found]
