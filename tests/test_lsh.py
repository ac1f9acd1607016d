"""Approximate neighbours against the exact join."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from txscore.operators.lsh_neighbors import lsh_knn_join
from txscore.operators.neighbors import knn_join


def clustered(spark, n, seed, dim=24, first=0):
    centres = np.random.default_rng(1).normal(size=(60, dim)) * 4
    rng = np.random.default_rng(seed)
    x = centres[rng.integers(0, 60, n)] + rng.normal(size=(n, dim))
    return spark.createDataFrame([(first + i, list(map(float, v))) for i, v in enumerate(x)], "id long, vec array<double>")


@pytest.mark.parametrize("metric", ["l1", "l2"])
def test_recall_and_share(spark, metric):
    refs, queries = clustered(spark, 4000, 2), clustered(spark, 300, 3, first=10_000)
    want = {(r.q_id, r.r_id) for r in knn_join(queries, refs, 3, metric=metric).collect()}
    rows = lsh_knn_join(queries, refs, 3, metric=metric).collect()
    got = {(r.q_id, r.r_id): r.dist for r in rows}
    assert len(rows) == len(got) == 900 and {r["rank"] for r in rows} == {1, 2, 3}
    assert len(want & got.keys()) >= 0.9 * len(want)
    assert lsh_knn_join(queries, refs, 3, metric=metric, share_only=True) < 0.9
    vecs = {r.id: np.array(r.vec) for r in refs.union(queries).collect()}
    for (q, r), d in list(got.items())[:50]:
        diff = vecs[q] - vecs[r]
        assert d == pytest.approx(np.abs(diff).sum() if metric == "l1" else np.sqrt((diff ** 2).sum()))


def test_short_queries_self_and_empty_references(spark):
    refs = clustered(spark, 200, 4)
    far = spark.createDataFrame([(9999, [1e6] * 24)], "id long, vec array<double>")  # in no one's bucket
    got = lsh_knn_join(far, refs, 4).orderBy("rank").collect()
    assert [r.r_id for r in got] == [r.r_id for r in knn_join(far, refs, 4).orderBy("rank").collect()]
    own = lsh_knn_join(refs, refs, 2, exclude_self=True)
    assert own.where("q_id = r_id").isEmpty() and own.groupBy("q_id").count().where("count <> 2").isEmpty()
    assert lsh_knn_join(far, refs.limit(0), 2).collect() == []
    same = refs.withColumn("vec", F.array(*[F.lit(1.0)] * 24))  # one bucket, all ties: smallest ids
    assert sorted({r.r_id for r in lsh_knn_join(same, same, 2).collect()}) == [0, 1]


def test_query_has_k_rows_of_every_vector(spark):
    rows = E.queries()["knn_lsh_neighbors"](spark, SMALL).toPandas()
    assert len(rows) and (rows.groupby("q_id")["rank"].apply(lambda r: sorted(r) == list(range(1, len(r) + 1)))).all()
    assert rows.groupby("q_id").size().nunique() == 1


def test_feature_importances_of_the_forest(spark, monkeypatch):
    from txscore.operators import ensembles as N
    monkeypatch.setitem(N.TUNED, "RandomForest", N.TUNED["RandomForest"] | {"n_estimators": 20})
    rows = E.queries()["feature_importances"](spark, SMALL).collect()
    values = [r.importance for r in rows]
    assert 0 < len(rows) <= 20 and values == sorted(values, reverse=True) and sum(values) == pytest.approx(1, abs=1e-5)
