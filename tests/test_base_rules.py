"""Typed group keys, missing values, category identity, small groups, unlabelled rows."""

import datetime
import decimal
import math

import pytest
from pyspark.sql import functions as F

from txscore.operators import prep as P
from txscore.operators import sampling, smote
from txscore.operators.ordered import ordered_row_number
from txscore.sources import io


@pytest.mark.parametrize("kind, value", [
    ("double", 1e10), ("float", 0.1), ("double", float("nan")), ("timestamp", datetime.datetime(2024, 1, 2, 3, 4, 5, 678900)),
    ("decimal(20,10)", decimal.Decimal(0)), ("string", None), ("date", datetime.date(2020, 2, 29)),
    ("boolean", True), ("string", "a\u0001b"), ("binary", bytearray(b"\x00\xff"))])
def test_row_numbers_for_any_group_type(spark, kind, value):
    rows = [(value, i) for i in range(600)] + [(None, 10_000 + i) for i in range(50)]
    df = spark.createDataFrame(rows, f"g {kind}, i int").repartition(4)
    got = ordered_row_number(df, ["g"], [F.col("i")], "rn")
    first = got.where("i < 10000").orderBy("i").collect()
    last = 650 if value is None else 600
    assert [r.rn for r in first] == list(range(1, 601))
    assert got.agg(F.max("rn")).first()[0] == last


def test_nan_is_missing_everywhere(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x,c\n1,NaN,a\n2,,b\n3,1.5,c\n4,2.5,d\n")
    df = io.read_csv(spark, str(tmp_path / "a.csv"), "id int, x double, c string")
    assert [r.x for r in df.orderBy("id").collect()] == [None, None, 1.5, 2.5]
    raw = spark.createDataFrame([(float("nan"),), (None,), (1.0,), (2.0,)], "x double")
    for table in (df, raw):
        assert P.null_rates(table, ["x"]).first().null_rate == 0.5
    assert P.soft_double(F.lit("nan")) is not None
    assert [r[0] for r in raw.select(P.soft_double(F.col("x"))).collect()] == [None, None, 1.0, 2.0]


def test_category_identity_in_fit_and_transform(spark):
    spelled = ["13926", "13926.0", " ", "NaN", "visa", "1e3", "1000"]
    rows = [(i, spelled[i % 7], float(i % 5) if i % 4 else math.nan, i % 2) for i in range(140)]
    text = spark.createDataFrame([(i, c, str(x), y) for i, c, x, y in rows],
                                 "tx_id long, card string, amt string, label int")
    model, _ = P.fit_preparation(text, text, ["card", "absent"], ["amt", "gone"], k=20)
    values = {v for f, v in model.dummies if f == "card"}
    assert values <= {"13926", "visa", "1000"} and "13926" in values
    assert model.cat_cols == ["card"] and model.num_cols == ["amt"]
    typed = spark.createDataFrame([(i, 13926.0, x, y) for i, _, x, y in rows if i % 7 == 1],
                                  "tx_id long, card double, amt double, label int")
    a = {r.tx_id: r[2:] for r in model.transform(text).collect()}
    b = {r.tx_id: r[2:] for r in model.transform(typed).collect()}
    assert b and all(a[i] == v for i, v in b.items())
    assert all(x is not None and not math.isnan(x) for v in a.values() for x in v)


def test_smote_uses_each_groups_own_neighbours(spark):
    rows = [(g * 1000 + i, int(i < n), [float(i), float(i * i % 7)], g)
            for g, n in ((0, 12), (1, 2)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, label int, vec array<double>, g int")
    out = smote.smote(df, ratio=0.5, group="g").where("is_synthetic")
    per = {r.g: r.n for r in out.groupBy("g", "base_id").agg(F.countDistinct("neighbor_id").alias("k"))
           .groupBy("g").agg(F.max("k").alias("n")).collect()}
    assert per[0] > 1 and per[1] == 1
    counts = {r.g: r["count"] for r in out.groupBy("g").count().collect()}
    assert counts == {0: 42, 1: 57}
    with pytest.raises(ValueError, match="fewer than two"):
        smote.smote(df.where("g = 0 or label = 0 or id = 1000"), ratio=0.5, group="g")


def test_rows_without_label_are_in_no_part(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(200)], "tx_id long, label int")
    parts = sampling.stratified_split(df)
    assert parts.where("label is null and part is not null").count() == 0
    assert parts.where("part is null").count() == 20


def test_knn_bands_prune_clustered_vectors_and_slices_bound_hot_bands(spark, monkeypatch):
    import numpy as np
    from txscore.operators import neighbors as N
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 3)) * 100
    x = np.concatenate([c + rng.normal(size=(60, 3)) * .1 for c in centers])
    flat = rng.normal(size=(2400, 64))
    frame = lambda a, n0=0: spark.createDataFrame(
        [(n0 + i, list(map(float, v))) for i, v in enumerate(a)], "id long, vec array<double>")
    assert N.candidate_share(frame(x[::10]), frame(x), 3) < 0.2
    assert N.candidate_share(frame(flat[:50]), frame(flat), 3) > 0.9  # nothing to prune here
    # a third of the references and queries are one vector: slices of a few rows give the same
    hot = np.concatenate([x[:300], np.repeat(x[:1], 150, 0)])
    whole = N.knn_join(frame(hot), frame(hot), 3, exclude_self=True)
    want = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(N, "SLICE_ROWS", 40)
    monkeypatch.setattr(N, "SLICE_QUERIES", 50)
    got = sorted(map(tuple, N.knn_join(frame(hot), frame(hot), 3, exclude_self=True).collect()))
    assert got == want and len(got) == 3 * len(hot)


def test_rank_values_are_exact_for_any_spread(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    cols = {"even": rng.random(5000), "ties": rng.integers(0, 4, 5000).astype(float),
            "wide": np.concatenate([np.exp(rng.normal(size=4000) * 60), -np.exp(rng.normal(size=1000) * 60)]),
            "huge": np.concatenate([[-1.7e308, 1.7e308], rng.normal(size=4998)]), "one": np.full(5000, 3.25)}
    df = spark.createDataFrame([(n, float(v)) for n, a in cols.items() for v in a], "feature string, value double")
    stats = {n: {"n": len(a), "lo": a.min(), "hi": a.max()} for n, a in cols.items()}
    wanted = {n: {0, 1, 1250, 2499, 2500, 3749, 4999} for n in cols}
    got = P.rank_values(df, wanted, stats)
    assert got == {(n, r): np.sort(cols[n])[r] for n in cols for r in wanted[n]}


def test_time_features_need_their_column_and_features_keep_their_order(spark):
    df = spark.createDataFrame([(i, float(i % 9), "ab"[i % 2], i % 2) for i in range(90)],
                               "tx_id long, x double, c string, label int")
    assert P.with_temporal(df).columns == df.columns
    model, _ = P.fit_preparation(df, df, ["c"], ["x", "days"], k=10)
    one = model.transform(df)
    other = model.transform(df.select("label", "c", "x", "tx_id"))  # the input's order doesn't matter
    assert one.columns == ["tx_id", "label", *model.selected] == other.columns
    again = P.PreparedModel.from_json(model.to_json())
    assert sorted(map(tuple, again.transform(df).collect())) == sorted(map(tuple, one.collect()))


def test_materialized_tables_can_be_cleared(spark):
    from txscore.session import clear_materialized, materialize
    table = materialize(spark.range(10))
    path = table.inputFiles()[0].rsplit("/", 1)[0]
    assert spark.read.parquet(path).count() == 10
    other = spark.newSession()
    clear_materialized(other)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()
