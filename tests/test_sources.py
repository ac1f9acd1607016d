"""The model store, feature alignment, report logs, parameter cells, rule text, keyed
permutations and the stream that explains what a fitted model flags."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from test_models import learnable
from txscore.operators import ensembles as N
from txscore.operators import explain as X
from txscore.operators import tree_shapley as T
from txscore.plans import learning as L
from txscore.sources import logs, rules, store
from txscore.streaming import scoring


# --- store ------------------------------------------------------------------

def test_last_whole_version_is_taken(spark, tmp_path):
    s = store.ModelStore(spark, str(tmp_path))
    assert s.latest() is None
    one = s.publish({"a": spark.range(3)}, ["x", "y"], "k1")
    s.publish({"a": spark.range(5)}, ["y"], "k2")
    spark.range(9).write.parquet(f"{tmp_path}/v3/a")  # a lost job's version: no manifest
    assert (one.version, s.latest().version, s.latest("k1").version) == (1, 2, 1)
    assert s.latest("k1").features == ["x", "y"] and s.latest("k1").table("a").count() == 3
    assert s.latest("none") is None
    three = s.publish({"a": spark.range(7)}, ["z"], "k1")
    assert three.version == 3 and s.latest("k1").table("a").count() == 7
    with pytest.raises(ValueError, match="no table b"):
        three.table("b")


def test_fingerprint_depends_on_content_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, t string")
    key = store.fingerprint(df, k=3)
    assert key == store.fingerprint(df.orderBy(F.desc("i")).repartition(3), k=3)
    assert key != store.fingerprint(df, k=4) and key != store.fingerprint(df.union(df), k=3)
    assert key != store.fingerprint(df.withColumn("t", F.lit("a")), k=3)


def test_alignment_by_name_and_by_position(spark):
    df = spark.createDataFrame([(1, 2.0, 3, "x")], "b int, a double, c int, other string")
    assert tuple(df.select(store.aligned(df, ["a", "b", "c"])).first()) == (2.0, 1.0, 3.0)
    with pytest.raises(ValueError, match="'d'"):
        store.aligned(df, ["a", "d"])
    vectors = df.select(store.vector(["c", "b", "a"]), F.array(F.lit(1.0)).alias("bare"))
    assert tuple(vectors.select(store.aligned(vectors, ["a", "c"], "vec")).first()) == (2.0, 3.0)
    assert vectors.schema["vec"].metadata["features"] == ["c", "b", "a"]
    with pytest.raises(ValueError, match="no feature names"):
        store.aligned(vectors, ["a"], "bare")


def test_stored_models_score_as_the_fitted_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(N, "TUNED", {f: p | ({"n_estimators": 20} if "n_estimators" in p else {})
                                     for f, p in N.TUNED.items()})
    s = store.ModelStore(spark, str(tmp_path))
    first = L.stored_models(spark, SMALL, s)
    assert L.stored_models(spark, SMALL, s).version == first.version == 1  # fitted once
    test = L.PP.split_tx(spark, SMALL).where(F.col("part") == "test")
    got = {(r.tx_id, r.model): r.score for r in L.score_raw(test, s.latest()).collect()}
    train, ready, feats = L.prepared_split(spark, SMALL)
    want = {(r.tx_id, r.model): r.score for r in L.score_all(ready, *L.fitted_models(spark, train, feats), feats).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    # a scorer takes up a version that is published later
    scorer = L.batch_scorer(spark, SMALL, s)
    before = {(r.tx_id, r.model): r.score for r in scorer(test).collect()}
    old = s.latest()
    one = {t: old.table(t) for t in old.tables} | {"trees": old.table("trees").where("family = 'DecisionTree'")}
    s.publish(one, old.features, L.models_key(spark, SMALL))
    after = {r.model for r in scorer(test).collect()}
    assert before == pytest.approx(got) and after == {"DecisionTree", "KNN", "NaiveBayes"}


# --- logs --------------------------------------------------------------------

def test_a_repeated_run_leaves_one_copy(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "model string, n int")
    for run in ("r1", "r2", "r1"):
        logs.write_run(df, f"{tmp_path}/log", run)
    assert sorted((r.run_id, r.model) for r in spark.read.parquet(f"{tmp_path}/log").collect()) == [
        ("r1", "a"), ("r1", "b"), ("r2", "a"), ("r2", "b")]


def test_batches_of_a_text_log_are_numbered(spark, tmp_path):
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 6, size=41).tolist()
    batches = [[f'Set{i},"M ""{b}"", x",{b + i / 8}' for i in range(n)] for b, n in enumerate(sizes, 1)]
    text = "Set,Model,Accuracy\n" + "\n\n".join("\n".join(b) for b in batches) + "\n\n\n"
    (tmp_path / "one.csv").write_text(text)
    (tmp_path / "two.csv").write_text("\n\nSet,Model,Accuracy\nA,m,0.5\n\n\n\nB,m,\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")  # a file in many parts
    try:
        rows = logs.read_text_log(spark, str(tmp_path), "set string, model string, accuracy double").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    one = sorted((r.batch, r.line, r.set, r.model, r.accuracy) for r in rows if r.file.endswith("one.csv"))
    assert [x[0] for x in one] == [b for b, n in enumerate(sizes, 1) for _ in range(n)]
    assert [x[2:] for x in one] == [(f"Set{i}", f'M "{b}", x', b + i / 8) for b, n in enumerate(sizes, 1) for i in range(n)]
    assert sorted((r.batch, r.set, r.accuracy) for r in rows if r.file.endswith("two.csv")) == [
        (1, "A", 0.5), (2, "B", None)]


def test_text_batches_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("Test", 'q"x', 0.25), ("Training", "a,b", None)], "s string, m string, v double")
    for run in ("1", "2", "2"):
        logs.write_text_batch(df, f"{tmp_path}/t", run, ["s"])
    back = logs.read_text_log(spark, f"{tmp_path}/t", "s string, m string, v double", header=False)
    assert sorted((r.file.count("run_id="), r.batch, r.s, r.m, r.v or 0) for r in back.collect()) == sorted(
        [(1, 1, "Test", 'q"x', 0.25), (1, 1, "Training", "a,b", 0)] * 2)


def test_parameter_cells_keep_mixed_types(spark):
    df = spark.createDataFrame([(1, 0.5, None, 'a "b"')], "n int, rate double, depth int, name string")
    cell = df.select(logs.params_cell("n", "rate", "depth", "name", flag=False).alias("p"))
    assert cell.select(logs.decode_params("p")).first()[0] == {
        "n": "1", "rate": "0.5", "depth": None, "name": 'a "b"', "flag": "false"}
    # cells as other programs write them
    other = spark.createDataFrame([('{"max_depth": null, "gamma": 1.0, "n": 1000, "splitter": "random"}',), ("[1]",), (None,)],
                                  "p string")
    got = other.select(logs.param("p", "gamma", "double"), logs.param("p", "n", "int"), logs.param("p", "max_depth", "int"),
                       logs.param("p", "splitter", "int")).collect()
    assert [tuple(r) for r in got] == [(1.0, 1000, None, None), (None,) * 4, (None,) * 4]


# --- rule text ------------------------------------------------------------------

def test_rule_text_round_trip(spark, tmp_path):
    def tree(depth, at=0):
        if depth == 0 or (at * 7 + depth) % 5 == 0:
            return [([], at % 2)]
        cond = f"feature_{at % 9} {{}} {at}.50"
        return [([cond.format(op), *path], c) for op, side in (("<=", 2 * at + 1), (">", 2 * at + 2))
                for path, c in tree(depth - 1, side)]

    def lines(leaves, depth=0):
        if len(leaves) == 1 and len(leaves[0][0]) == depth:
            return ["|   " * depth + f"|--- class: {leaves[0][1]}"]
        out = []
        for cond, own in itertools.groupby(leaves, lambda x: x[0][depth]):
            out += ["|   " * depth + "|--- " + cond.replace("> ", ">  "), *lines(list(own), depth + 1)]
        return out

    trees = {f"t{i}.txt": tree(i, i) for i in range(1, 6)} | {"leaf.txt": [([], 1)]}
    for name, leaves in trees.items():
        (tmp_path / name).write_text("\n".join(lines(leaves)) + "\n")
    read = rules.read_rules(spark, str(tmp_path))
    for name, leaves in trees.items():
        own = read.where(F.col("file").endswith(f"/{name}"))
        assert [(list(r.path), r["class"]) for r in own.orderBy("leaf").collect()] == leaves
        rules.write_rules(own, f"{tmp_path}/out-{name}")
        again = rules.read_rules(spark, f"{tmp_path}/out-{name}").orderBy("leaf").collect()
        assert [(list(r.path), r["class"], r.leaf) for r in again] == [(p, c, i) for i, (p, c) in enumerate(leaves)]
    named = rules.read_rules(spark, f"{tmp_path}/t1.txt", ["a", "b b"]).orderBy("leaf").collect()
    assert [r.rule for r in named] == ["`b b` <= 1.50", "`b b` > 1.50"]
    assert read.where("file like '%leaf.txt'").first().rule == "TRUE"


# --- keyed permutations -----------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 5, 30, 101, 1000, 4097])
def test_keyed_permutation_is_one(n):
    images = [X.keyed_permutation(np.arange(n), n, r) for r in range(4)]
    assert all(sorted(p.tolist()) == list(range(n)) for p in images)
    if n >= 30:
        assert len({tuple(p.tolist()) for p in images}) == 4
        assert all(abs(np.corrcoef(np.arange(n), p)[0, 1]) < 4 / np.sqrt(n) for p in images)


def test_rows_are_numbered_without_gaps(spark):
    for rows in (spark.range(100).repartition(7), spark.range(50, 150).repartition(5),
                 spark.range(10).select(F.col("id").cast("string").alias("id")), spark.range(0)):
        numbered, n = X.numbered_rows(rows, "id")
        assert sorted(r["_pos"] for r in numbered.collect()) == list(range(n)) and n == rows.count()


def test_importance_of_the_only_feature_that_matters(spark):
    x, _ = learnable(400)
    y = (np.nan_to_num(x[:, 1]) > 0).astype(int)
    rows = spark.createDataFrame([(f"r{i}", int(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y, strict=True))],
                                 "tx_id string, label int, a double, b double, c double, d double, e double")
    got = {r.feature: r for r in X.permutation_importance(rows, list("abcde"), lambda z: np.nan_to_num(z[:, 1]) > 0,
                                                          n_repeats=5).collect()}
    assert got["b"].importance_mean > 0.3 and all(got[f].importance_mean == 0 for f in "acde")


# --- explained on the stream --------------------------------------------------------

def test_flagged_records_are_explained_once(spark, tmp_path):
    x, y = learnable(400)
    x = np.nan_to_num(x)
    cols = [f"c{i}" for i in range(5)]
    schema = "tx_id long, label int, " + ", ".join(f"{c} double" for c in cols)
    rows = spark.createDataFrame([(i, int(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y, strict=True))], schema)
    model = N.load_models(N.fit_table(rows, cols, ["XGBoost"], {"XGBoost": {"n_estimators": 30}}))["XGBoost",]
    for part in (rows, rows.where("tx_id < 200")):  # half of the records arrive again
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = scoring.explain_flagged(stream.select("tx_id", *cols), spark, "XGBoost", model, cols, x[:20], "test_flagged", 3)
    flagged = np.flatnonzero(model.decision(x) > 0)
    batch = T.top_of_record(T.tree_shapley(rows.where(F.col("tx_id").isin(flagged.tolist())), x[:20], cols, model), 3)
    key = lambda df: sorted((r.tx_id, r["rank"], r.feature, round(r.phi, 9)) for r in df.collect())
    assert len(flagged) > 10 and key(got) == key(batch)


def test_exact_shapley_of_every_test_record(spark):
    rows = E.queries()["shapley_boosted"](spark, SMALL).collect()
    assert len({r.tx_id for r in rows}) == 250 and max(r["rank"] for r in rows) <= 14


def test_a_table_of_several_files_is_streamed(spark, tmp_path):
    for name in ("events", "embeddings"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").repartition(2).write.parquet(f"{tmp_path}/{name}.parquet")
    assert scoring.run_available_now(scoring.events_stream(spark, str(tmp_path)).select("event_id"), spark, "folder").count() == 1000
    got, want = (sorted(map(tuple, E.queries()["stream_knn_scores"](spark, d).collect())) for d in (str(tmp_path), SMALL))
    assert got == want and len(got)
