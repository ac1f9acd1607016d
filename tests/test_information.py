"""Nearest-neighbour mutual information against its definition, and pluggable score functions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txscore.operators import information as I
from txscore.operators import prep as P


def psi(n):
    return -0.5772156649015329 + sum(1 / j for j in range(1, n))


def brute(x, y, k):
    n, total = len(x), 0.0
    size = {c: int((y == c).sum()) for c in set(y)}
    keep = [i for i in range(n) if size[y[i]] > 1]
    for i in keep:
        kk = min(k, size[y[i]] - 1)
        own = np.sort(np.abs(x[(y == y[i]) & (np.arange(n) != i)] - x[i]))
        m = int((np.abs(x - x[i]) < own[kk - 1]).sum())
        total += psi(kk) - psi(size[y[i]]) - psi(max(m, 1))
    return max(0.0, psi(len(keep)) + total / len(keep))


def test_digamma(spark):
    got = spark.range(1, 200).select("id", I.digamma(F.col("id")).alias("p")).collect()
    assert all(abs(r.p - psi(r.id)) < 1e-11 for r in got)


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_equals_definition(spark, k):
    rng = np.random.default_rng(k)
    y = rng.integers(0, 3, 300)
    y[0] = 9  # a label with one row
    cols = {"near": y + rng.normal(size=300) * .5, "far": rng.normal(size=300), "heavy": np.exp(rng.normal(size=300) * 3)}
    df = spark.createDataFrame([(i, int(y[i]), *(float(c[i]) for c in cols.values())) for i in range(300)],
                               "tx_id long, label int, near double, far double, heavy double").repartition(5)
    got = {r.feature: r.mi for r in I.nearest(df, list(cols), I.discrete_flags(list(cols)), k=k).collect()}
    for name, x in cols.items():
        assert got[name] == pytest.approx(brute(x, y, k), abs=1e-9)
    assert got["near"] > 0.3 > got["far"]


def test_discrete_features_are_counted(spark):
    rows = [(i, i % 2, float(i % 2), float(i % 3 == 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "tx_id long, label int, cat__a double, cat__b double")
    got = {r.feature: r.mi for r in I.nearest(df, ["cat__a", "cat__b"], I.discrete_flags(["cat__a", "cat__b"])).collect()}
    assert got["cat__a"] == pytest.approx(math.log(2)) and got["cat__b"] == pytest.approx(0, abs=1e-9)


def test_any_score_function_ranks_the_features(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "ab"[i % 2], float(i % 7), float(rng.normal()), int(i % 7 > 4)) for i in range(210)]
    df = spark.createDataFrame(rows, "tx_id long, c string, x double, z double, label int")
    seen = {}

    def by_name(table, features, discrete, label, id_col):
        seen.update(discrete)
        assert {label, id_col} <= set(table.columns)
        return table.sparkSession.createDataFrame(
            [(f, 1.0 if f == "num__z" else 0.0) for f in features], "feature string, mi double")

    model, _ = P.fit_preparation(df, df, ["c"], ["x", "z"], k=1, score_function=by_name)
    assert model.selected == ["num__z"]
    assert seen == {f: f.startswith("cat__") for f in seen} and any(seen.values())
    assert P.fit_preparation(df, df, ["c"], ["x", "z"], k=1, score_function=I.nearest)[0].selected == ["num__x"]


@pytest.mark.parametrize("copies", [1, 2])
def test_nearest_over_many_blocks_and_cells_is_worked_out_once(spark, monkeypatch, copies):
    for name, n in (("BLOCK_ROWS", 16), ("CELL_ROWS", 20), ("HELD_ROWS", 32)):
        monkeypatch.setattr(I, name, n, raising=False)
    rng = np.random.default_rng(5)
    y, x = rng.integers(0, 3, 200), np.round(rng.normal(size=200), 1) * 3
    rows = [(i, int(y[i]), float(x[i])) for i in range(200)] * copies + [(900, None, 0.5), (None, 1, 0.25)]
    df = spark.createDataFrame(rows, "tx_id long, label int, x double").repartition(4)
    found = I.nearest(df, ["x"], I.discrete_flags(["x"]))
    assert "Exchange" not in found._jdf.queryExecution().toString()  # a table that is read, whoever asks
    # the definition on noisy values: a row of one label, id and value has the neighbours of all its copies
    noisy = df.select("tx_id", "label", (F.col("x") + (I.uniform(I.row_hash("tx_id", 42, F.lit("x"))) - F.lit(0.5))
              * F.lit(I.NOISE * df.agg(F.greatest(F.avg(F.abs("x")), F.lit(1.0))).first()[0])).alias("x")).collect()
    v = np.array([r.x for r in noisy])
    own = {c: sum(r.label == c for r in noisy) for c in (0, 1, 2)}
    each: dict[int, list] = {}
    for i, r in enumerate(noisy):
        if r.label is not None and r.tx_id is not None:
            of = np.sort(np.abs(v[[j for j, q in enumerate(noisy) if j != i and q.label == r.label]] - r.x))[:6]
            each.setdefault(r.tx_id, [r.label, r.x, []])[2].extend(of[:3] if copies == 1 else of)
    total = 0.0
    for label, at, gaps in each.values():
        # the two copies see each other; then the nearest of either side, which both may see
        r = np.sort(gaps)[2]
        r -= 1e-15 * (abs(at) + r)
        total += psi(3) - psi(own[label]) - psi(max(1, int(((v > at - r) & (v < at + r)).sum())))
    assert found.first()["mi"] == pytest.approx(max(0.0, psi(len(each)) + total / len(each)), abs=1e-9)
