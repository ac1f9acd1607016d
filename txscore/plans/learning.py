"""Model queries: the six families (rows-only checks: fits are not SQL), the
cross-validated grid search, and the best-candidate selection (SQL oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.functions.algebra import r6
from txscore.operators import ensembles as E
from txscore.operators import metrics as M
from txscore.operators import prep as P
from txscore.operators import samme
from txscore.operators import sampling as SM
from txscore.operators import trees as T
from txscore.operators.bayes import GaussianNBModel, gnb_fit_table
from txscore.operators.neighbors import knn_classify, knn_join
from txscore.operators.smote import smote
from txscore.operators.vote import majority_vote
from txscore.plans import preparation as PP
from txscore.plans import sqlkit as S
from txscore.plans.modeling import GNB_FEATURES, KNN_K, SMOTE_RATIO, scaled_split
from txscore.plans.registry import register
from txscore.plans.statistics import FOLD_SCORES_SQL, cv_fold_scores
from txscore.session import materialize
from txscore.sources import io as IO
from txscore.sources import store as ST
from txscore.sources.tables import SCORES_SQL, TX_SQL, with_ctes

GNB_GRID = [1e-9, 1e-5, 1e-2]
# Candidates of the grid search, by family: the tuned parameters and variations of them.
GRID: list[tuple[str, str, dict]] = [
    *[("NaiveBayes", f"smoothing {v!r}", {"var_smoothing": v}) for v in GNB_GRID],
    *[("KNN", f"k {k}", {"n_neighbors": k}) for k in (KNN_K, 7)],
    *[("DecisionTree", f"{c} {s}", {"criterion": c, "splitter": s})
      for c, s in (("entropy", "random"), ("gini", "best"))],
    *[("RandomForest", f"split {m}", {"min_samples_split": m}) for m in (5, 20)],
    *[("AdaBoost", f"rate {r}", {"learning_rate": r}) for r in (1.0, 0.5)],
    *[("XGBoost", f"gamma {g}", {"gamma": g}) for g in (1.0, 0.0)],
]
MODELS = ("AdaBoost", "DecisionTree", "KNN", "NaiveBayes", "RandomForest", "XGBoost")

# Scorers by name: a Column over a table of fold metrics (confusion counts and ranking metrics).
SCORERS: dict[str, Callable[[], Column]] = {
    name: (lambda n=name: F.col(n)) for name in [*M.RATE_METRICS, "roc_auc", "pr_auc"]}


def register_scorer(name: str, score: Callable[[], Column]) -> None:
    """Add a scorer, e.g. ``lambda: F.col("tp") - 10 * F.col("fn")``."""
    SCORERS[name] = score


def _train_test(spark, sf_dir):
    sc = scaled_split(spark, sf_dir)
    return sc.where(F.col("part") == "train"), sc.where(F.col("part") == "test")


def _scores_out(df: DataFrame) -> DataFrame:
    return df.select("tx_id", "label", r6("score").alias("score"), F.col("pred").cast("int").alias("pred"))


def family_scores(spark, sf_dir, family: str) -> DataFrame:
    """The family with its tuned parameters, fitted on all train rows; all test rows."""
    train, test = _train_test(spark, sf_dir)
    table = materialize(E.fit_table(E.fit_sample(train), GNB_FEATURES, [family]))
    return _scores_out(E.score_models(test, table, GNB_FEATURES))


@register("dt_scores", "MDL-3,MDL-9")
def dt_scores_df(spark, sf_dir):
    return family_scores(spark, sf_dir, "DecisionTree")


@register("rf_scores", "MDL-4,MDL-9")
def rf_scores_df(spark, sf_dir):
    return family_scores(spark, sf_dir, "RandomForest")


@register("gbt_scores", "MDL-6,MDL-7,MDL-9")
def gbt_scores_df(spark, sf_dir):
    return family_scores(spark, sf_dir, "XGBoost")


@register("samme_scores", "MDL-5,MDL-9")
def samme_scores_df(spark, sf_dir):
    return family_scores(spark, sf_dir, "AdaBoost")


# Bins of the transaction view that need no fit: the cells of the checked boosting rounds.
CELL_SQL = ("CAST(k AS INT)", "CAST(least(floor(amt / 10), 40) AS INT)", "CAST(floor(dt / 3600) % 24 AS INT)")
SAMME_ROUNDS = 4
POSITIVE_WEIGHTS = (1.0, 4.0, 20.0, 100.0)


def tx_cells(spark, sf_dir) -> DataFrame:
    """(bins, n, pos): the different bin vectors of all transactions."""
    from txscore.sources.tables import tx_view
    bins = F.array(*[F.expr(c) for c in CELL_SQL])
    return materialize(tx_view(spark, sf_dir).where("k is not null and dt is not null and amt is not null")
                       .groupBy(bins.alias("bins")).agg(F.count(F.lit(1)).cast("double").alias("n"),
                                                        F.sum(F.col("label").cast("double")).alias("pos")))


_CELLS_SQL = f"""cells AS (
  SELECT {', '.join(f'{c} AS b{i}' for i, c in enumerate(CELL_SQL))}, CAST(COUNT(*) AS DOUBLE) AS n,
         CAST(SUM(label) AS DOUBLE) AS pos
  FROM tx WHERE k IS NOT NULL AND dt IS NOT NULL AND amt IS NOT NULL GROUP BY ALL)"""


def _flat_sql(source: str, cols: str) -> str:
    return " UNION ALL ".join(f"SELECT {i} AS feature, b{i} AS bin, {cols} FROM {source}" for i in range(len(CELL_SQL)))


def _samme_sql() -> str:
    """Each round as the CTEs of its sums, its stump and the weights after it."""
    b = ", ".join(f"b{i}" for i in range(len(CELL_SQL)))
    ctes = [TX_SQL, _CELLS_SQL, f"""w0 AS (
  SELECT {b}, y, w / SUM(w) OVER () AS w FROM (SELECT {b}, 1 AS y, pos AS w FROM cells
         UNION ALL SELECT {b}, 0, n - pos FROM cells) WHERE w > 0)"""]
    for i in range(SAMME_ROUNDS):
        vote = f"CASE WHEN [{b}][s.feature + 1] <= s.bin THEN s.vl ELSE s.vr END"
        ctes += [f"""s{i} AS (
  SELECT feature, bin, SUM(w) AS n, SUM(CASE WHEN y = 1 THEN w ELSE 0 END) AS pos FROM ({_flat_sql(f'w{i}', 'y, w')})
  GROUP BY ALL)""", f"""c{i} AS (
  SELECT *, tn - ln AS rn, tp - lp AS rp FROM (
    SELECT feature, bin, MAX(bin) OVER f AS last, SUM(n) OVER f AS tn, SUM(pos) OVER f AS tp,
           SUM(n) OVER l AS ln, SUM(pos) OVER l AS lp FROM s{i}
    WINDOW f AS (PARTITION BY feature),
           l AS (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))""",
                 f"""b{i}x AS (
  SELECT feature, bin, CAST(lp > ln - lp AS INT) AS vl, CAST(rp > rn - rp AS INT) AS vr,
         ((CASE WHEN lp > ln - lp THEN ln - lp ELSE lp END) + (CASE WHEN rp > rn - rp THEN rn - rp ELSE rp END)) / tn
           AS error, round(lp * lp / ln + rp * rp / rn - tp * tp / tn, 12) AS gain
  FROM c{i} WHERE bin < last ORDER BY gain DESC, feature, bin LIMIT 1)""",
                 f"r{i} AS (SELECT *, ln((1 - error) / error) AS alpha FROM b{i}x)", f"""w{i + 1} AS (
  SELECT {b}, y, w * (CASE WHEN {vote} <> y THEN exp(s.alpha) ELSE 1 END)
         / (1 - s.error + s.error * exp(s.alpha)) AS w FROM w{i}, r{i} s)"""]
    body = " UNION ALL ".join(f"SELECT {i + 1} AS round, feature, bin, vl AS \"left\", vr AS \"right\", "
                              f"{S.r6('error', 9)} AS error, {S.r6('alpha', 9)} AS alpha FROM r{i}"
                              for i in range(SAMME_ROUNDS))
    return with_ctes(*ctes, body=body)


@register("samme_rounds", "MDL-5", _samme_sql())
def samme_rounds_df(spark, sf_dir):
    """The first boosting rounds over the cells of all transactions: each an aggregate over the
    cells and a projection of their new weights."""
    found = samme.rounds(tx_cells(spark, sf_dir), SAMME_ROUNDS)
    rows = [(i, s["feature"], s["bin"], s["left"], s["right"], s["error"], s["alpha"]) for i, s in enumerate(found, 1)]
    out = spark.createDataFrame(rows, "round int, feature int, bin int, left int, right int, error double, alpha double")
    return out.select("round", "feature", "bin", "left", "right", r6("error", 9).alias("error"),
                      r6("alpha", 9).alias("alpha"))


@register("positive_weight_sweep", "MDL-6,MDL-7", with_ctes(TX_SQL, _CELLS_SQL, f"""rows AS (
  SELECT c.*, weight, (weight * pos - (n - pos)) * 0.5 AS g, (weight * pos + (n - pos)) * 0.25 AS h
  FROM cells c, (SELECT unnest([{', '.join(f'{w!r}::DOUBLE' for w in POSITIVE_WEIGHTS)}]) AS weight))""", f"""sums AS (
  SELECT weight, feature, bin, SUM(g) AS g, SUM(h) AS h FROM ({_flat_sql('rows', 'weight, g, h')}) GROUP BY ALL)""",
    """cuts AS (
  SELECT *, lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1) AS gain FROM (
    SELECT weight, feature, bin, MAX(bin) OVER f AS last, SUM(g) OVER f AS tg, SUM(h) OVER f AS th,
           SUM(g) OVER l AS lg, SUM(h) OVER l AS lh FROM sums
    WINDOW f AS (PARTITION BY weight, feature), l AS (PARTITION BY weight, feature ORDER BY bin
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) WHERE bin < last)""", body=f"""
SELECT weight, {S.r6('tg')} AS g, {S.r6('th')} AS h, {S.r6('tg / (th + 1)')} AS leaf, feature, bin, {S.r6('gain')} AS gain
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY weight ORDER BY round(gain, 9) DESC, feature, bin) AS rn FROM cuts)
WHERE rn = 1"""))
def positive_weight_sweep_df(spark, sf_dir):
    """First boosting round of the logistic loss at several weights of the positive class: the
    gradient sums, the leaf without a split and the best split."""
    out = samme.newton_splits(tx_cells(spark, sf_dir), POSITIVE_WEIGHTS)
    return out.select("weight", *[r6(c).alias(c) for c in ("g", "h", "leaf", "gain")], "feature", "bin")


# Rules of a depth-3 surrogate over the transaction view, as a rule table: leaf, condition, class.
RULES = ((0, "amt <= 50.0 AND k <= 40", 0), (1, "amt <= 50.0 AND k > 40", 0),
         (2, "amt > 50.0 AND amt <= 150.0", 0), (3, "amt > 150.0 AND product = 'error'", 1),
         (4, "amt > 150.0 AND product = 'purchase'", 1), (5, "amt > 150.0", 0))


def apply_rules(df: DataFrame, rules=RULES, label: str = "label") -> DataFrame:
    """(leaf, class, n, purity): each row goes to the first rule that holds; purity is the share
    of its rows whose label is the rule's class. A rule without rows has n 0."""
    leaf = cls = None
    for no, cond, c in rules:
        hit = F.expr(cond)
        leaf = F.when(hit, F.lit(no)) if leaf is None else leaf.when(hit, F.lit(no))
        cls = F.when(hit, F.lit(c)) if cls is None else cls.when(hit, F.lit(c))
    per = df.select(leaf.alias("leaf"), cls.alias("class"), label).where("leaf is not null") \
        .groupBy("leaf").agg(F.count(F.lit(1)).alias("n"),
                             F.avg((F.col(label) == F.col("class")).cast("double")).alias("purity"))
    table = df.sparkSession.createDataFrame([(n, c) for n, _, c in rules], "leaf int, class int")
    return table.join(per, "leaf", "left").select("leaf", "class", F.coalesce("n", F.lit(0)).alias("n"), "purity")


@register("rule_apply", "EXP-5", with_ctes(TX_SQL, body=f"""
SELECT r.leaf, r.class, CAST(COUNT(t.leaf) AS BIGINT) AS n,
       {S.r6('avg(CASE WHEN t.label = r.class THEN 1.0 ELSE 0.0 END) FILTER (t.leaf IS NOT NULL)')} AS purity
FROM (VALUES {', '.join(f'({n}, {c})' for n, _, c in RULES)}) r(leaf, class)
LEFT JOIN (SELECT label, CASE {' '.join(f'WHEN {c} THEN {n}' for n, c, _ in RULES)} END AS leaf FROM tx) t
  ON t.leaf = r.leaf
GROUP BY r.leaf, r.class"""))
def rule_apply_df(spark, sf_dir):
    from txscore.sources.tables import tx_view
    return apply_rules(tx_view(spark, sf_dir)).select("leaf", "class", "n", r6("purity").alias("purity"))


# The same idea as indented text, as rule files hold it.
RULE_TEXT = """|--- amt <= 50.00
|   |--- k <= 40.00
|   |   |--- class: 0
|   |--- k >  40.00
|   |   |--- class: 0
|--- amt >  50.00
|   |--- amt <= 150.00
|   |   |--- class: 0
|   |--- amt >  150.00
|   |   |--- k <= 70.50
|   |   |   |--- class: 1
|   |   |--- k >  70.50
|   |   |   |--- class: 0"""
RULE_LEAVES = (("amt <= 50.00 AND k <= 40.00", 0), ("amt <= 50.00 AND k > 40.00", 0),
               ("amt > 50.00 AND amt <= 150.00", 0), ("amt > 50.00 AND amt > 150.00 AND k <= 70.50", 1),
               ("amt > 50.00 AND amt > 150.00 AND k > 70.50", 0))


@register("rule_text_apply", "SNK-7,EXP-5", with_ctes(TX_SQL, body=f"""
SELECT r.leaf, r.rule, r.class, CAST(COUNT(t.leaf) AS BIGINT) AS n,
       {S.r6('avg(CASE WHEN t.label = r.class THEN 1.0 ELSE 0.0 END) FILTER (t.leaf IS NOT NULL)')} AS purity
FROM (VALUES {', '.join(f"({i}, '{c}', {v})" for i, (c, v) in enumerate(RULE_LEAVES))}) r(leaf, rule, class)
LEFT JOIN (SELECT label, CASE {' '.join(f'WHEN {c} THEN {i}' for i, (c, _) in enumerate(RULE_LEAVES))} END AS leaf
           FROM tx) t ON t.leaf = r.leaf
GROUP BY r.leaf, r.rule, r.class"""))
def rule_text_apply_df(spark, sf_dir):
    """A rule file parsed into its rule table, written as text again, read back, and applied to
    every transaction."""
    from txscore.sources import rules as R
    from txscore.sources.tables import tx_view
    first, again = (IO.shared_path(spark, "rules") for _ in "ab")
    lines = spark.createDataFrame([(RULE_TEXT,)], "value string")  # line breaks make it a file of lines
    lines.coalesce(1).write.text(first)
    R.write_rules(R.read_rules(spark, first), again)
    table = R.read_rules(spark, again).orderBy("leaf")
    rules = [(r.leaf, r.rule, r["class"]) for r in table.collect()]  # the leaves of one shallow tree
    found = apply_rules(tx_view(spark, sf_dir), rules)
    return table.select("leaf", "rule").join(found, "leaf").select("leaf", "rule", "class", "n",
                                                                   r6("purity").alias("purity"))


@register("variance_importances", "SRT-3", with_ctes(TX_SQL, body=f"""
SELECT feature, {S.r6('v / SUM(v) OVER ()')} AS importance FROM (
  SELECT unnest(['amt', 'k', 'd1', 'v_sparse']) AS feature,
         unnest([var_pop(amt), var_pop(k), var_pop(d1), var_pop(v_sparse)]) AS v FROM tx)
ORDER BY importance DESC, feature LIMIT 3"""))
def variance_importances_df(spark, sf_dir):
    """A table of importances (share of the summed variances) cut to its top three."""
    from txscore.operators.explain import top_importances
    from txscore.sources.tables import tx_view
    cols = ["amt", "k", "d1", "v_sparse"]
    row = tx_view(spark, sf_dir).agg(*[F.var_pop(c).alias(c) for c in cols])
    long = row.unpivot([], cols, "feature", "v")
    total = row.select(sum((F.col(c) for c in cols), F.lit(0.0)).alias("total"))
    imp = long.join(F.broadcast(total)).select("feature", r6(F.col("v") / F.col("total")).alias("importance"))
    return top_importances(imp, "importance", 3)


def feature_importances_df(spark, sf_dir):
    """Importances of the forest, top 20 (rows per feature)."""
    from txscore.operators.explain import top_importances
    train, _ = _train_test(spark, sf_dir)
    table = E.fit_table(E.fit_sample(train), GNB_FEATURES, ["RandomForest"])
    share = E.importances(table, "RandomForest", len(GNB_FEATURES))
    imp = spark.createDataFrame(list(zip(GNB_FEATURES, map(float, share), strict=True)),
                                "feature string, importance double")
    return top_importances(imp, "importance", 20)


register("feature_importances", "EXP-1")(feature_importances_df)


# ---- end to end: preparation, oversampling, six models, one score table --------------

def prepared_split(spark, sf_dir) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, test, features): the fitted preparation (imputation, dummies, scaling, the best
    60 features by mutual information) applied to both parts, features named f0, f1, ..."""
    sp = PP.split_tx(spark, sf_dir)
    train = sp.where(F.col("part") == "train")
    prepared, _ = P.fit_preparation(sp, train, PP.CATS, PP.NUMS, string_cols=PP.CATS)
    out = materialize(numbered(prepared.transform(sp, keep=("tx_id", "label", "part")), prepared.selected,
                               ("tx_id", "label", "part")))
    return out.where(F.col("part") == "train"), out.where(F.col("part") == "test"), numbers(prepared.selected)


def numbers(features: list[str]) -> list[str]:
    return [f"f{i}" for i in range(len(features))]


def numbered(df: DataFrame, features: list[str], keep: tuple[str, ...]) -> DataFrame:
    """The columns ``features``, found by name, as f0, f1, ..."""
    return df.select(*[c for c in keep if c in df.columns],
                     *[c.alias(f"f{i}") for i, c in enumerate(ST.aligned(df, features))])


def fitted_models(spark, train: DataFrame, feats: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(model table, reference rows of KNN, parameters of naive Bayes) from prepared train rows; the
    references are the whole balanced table."""
    balanced = smote(train.withColumn("vec", F.array(*feats)), id_col="tx_id", ratio=SMOTE_RATIO)
    balanced = materialize(balanced.select("id", "label", "vec", *[F.col("vec")[i].alias(c)
                                                                   for i, c in enumerate(feats)]))
    sample = materialize(E.fit_sample(balanced, id_col="id"))
    return materialize(E.fit_table(sample, feats, id_col="id")), balanced, gnb_fit_table(balanced, feats)


def score_all(rows: DataFrame, table: DataFrame, refs: DataFrame, bayes: DataFrame, feats: list[str],
              trees: dict | None = None) -> DataFrame:
    """(tx_id, label, model, score, pred) of prepared rows by all six models; ``trees``: the table's
    ``sent_models`` if they are loaded."""
    cols = ["tx_id", "label", "model", "score", "pred"]
    trees = E.score_models(rows, table, feats, sent=trees).select(*cols)
    nb = GaussianNBModel.from_table(bayes, feats).transform(rows).withColumn("model", F.lit("NaiveBayes")).select(*cols)
    near = knn_join(rows.select(F.col("tx_id").alias("id"), F.array(*feats).alias("vec")), refs, KNN_K,
                    metric="l1")
    knn = (knn_classify(near, refs).join(rows.select(F.col("tx_id").alias("q_id"), "label"), "q_id")
           .select(F.col("q_id").alias("tx_id"), "label", F.lit("KNN").alias("model"), "score", "pred"))
    return trees.unionByName(nb).unionByName(knn)


def models_key(spark, sf_dir) -> str:
    """What the six models depend on: the transactions and the parameters."""
    from txscore.sources.tables import read_table
    return ST.fingerprint(read_table(spark, sf_dir, "events"), form=2, tuned=E.TUNED, k=KNN_K,
                          ratio=SMOTE_RATIO)


def stored_models(spark, sf_dir, store: ST.ModelStore | None = None) -> ST.Stored:
    """The stored version of the six models and their preparation for these transactions; fitted
    and published if there is none."""
    store, key = store or ST.ModelStore(spark), models_key(spark, sf_dir)
    if found := store.latest(key):
        return found
    sp = PP.split_tx(spark, sf_dir)
    train = sp.where(F.col("part") == "train")
    fitted, _ = P.fit_preparation(sp, train, PP.CATS, PP.NUMS, string_cols=PP.CATS)
    feats = numbers(fitted.selected)
    ready = materialize(numbered(fitted.transform(train), fitted.selected, ("tx_id", "label")))
    trees, refs, bayes = fitted_models(spark, ready, feats)
    frozen = spark.createDataFrame([(fitted.to_json(),)], "value string")
    return store.publish({"trees": trees, "references": refs, "bayes": bayes, "preparation": frozen},
                         fitted.selected, key)


def score_raw(rows: DataFrame, stored: ST.Stored) -> DataFrame:
    """Raw transactions scored by all six models of a stored version; its preparation and loaded
    trees are kept with it."""
    held = stored.held
    if not held:
        held["preparation"] = P.PreparedModel.from_json(stored.table("preparation").first()["value"])
        held["trees"] = E.sent_models(stored.table("trees"))
    if "label" not in rows.columns:  # arriving records have none
        rows = rows.withColumn("label", F.lit(None).cast("int"))
    ready = materialize(numbered(held["preparation"].transform(rows), stored.features, ("tx_id", "label")))
    return score_all(ready, stored.table("trees"), stored.table("references"), stored.table("bayes"),
                     numbers(stored.features), held["trees"])


def model_scores(spark, sf_dir) -> DataFrame:
    """Every test row scored by all six models, fitted on the whole prepared and oversampled train
    part and taken from the store."""
    test = PP.split_tx(spark, sf_dir).where(F.col("part") == "test")
    return score_raw(test, stored_models(spark, sf_dir))


def batch_scorer(spark, sf_dir, store: ST.ModelStore | None = None) -> Callable[[DataFrame], DataFrame]:
    """Function that scores raw transactions by the last whole version of the store, so that a
    stream takes up a new version with its next micro-batch."""
    store = store or ST.ModelStore(spark)
    now, key = stored_models(spark, sf_dir, store), models_key(spark, sf_dir)

    def score(rows: DataFrame) -> DataFrame:
        nonlocal now
        last = store.latest(key)
        if last.version != now.version:
            now = last
        return score_raw(rows, now)

    return score


@register("model_scores", "MDL-9,SMP-6,SNK-6,PRJ-11")
def model_scores_df(spark, sf_dir):
    return model_scores(spark, sf_dir).select("tx_id", "label", "model", r6("score").alias("score"), "pred")


@register("model_report", "MDL-9,EVL-8,EVL-9")
def model_report_df(spark, sf_dir):
    rep = M.metrics_report(model_scores(spark, sf_dir))
    return rep.select("model", "tn", "fp", "fn", "tp", *[r6(c).alias(c) for c in
                                                         [*M.RATE_METRICS, "roc_auc", "pr_auc"]])


@register("model_vote", "AGG-11,PRJ-12,STR-2")
def model_vote_df(spark, sf_dir):
    """Majority of the six fitted models for every test row."""
    return majority_vote(model_scores(spark, sf_dir))


@register("aligned_features", "PRJ-11,SNK-6", with_ctes(TX_SQL, body="""
SELECT tx_id, CAST(f.position AS INT) AS position, CASE f.position WHEN 0 THEN amt WHEN 1 THEN CAST(k AS DOUBLE)
       WHEN 2 THEN d1 ELSE CAST(dt AS DOUBLE) END AS value
FROM tx, (SELECT unnest([0, 1, 2, 3]) AS position) f"""))
def aligned_features_df(spark, sf_dir):
    """The stored feature order brought to a table with other columns in another order, and to a
    vector column that carries its names: one positional result of both."""
    from txscore.sources.tables import tx_view
    stored = ST.ModelStore(spark, IO.shared_path(spark, "store")).publish({}, ["amt", "k", "d1", "dt"])
    features = ST.ModelStore(spark, stored.path.rsplit("/", 1)[0]).latest().features
    tx = tx_view(spark, sf_dir)
    mixed = tx.select("tx_id", "dt", "v_sparse", "k", F.lit(0.0).alias("extra"), "d1", "amt")
    by_name = mixed.select("tx_id", F.array(*ST.aligned(mixed, features)[:2]).alias("v"))
    vectors = tx.select("tx_id", ST.vector(["dt", "label", "d1", "amt", "k"]))
    by_place = vectors.select("tx_id", F.array(*ST.aligned(vectors, features, "vec")[2:]).alias("w"))
    both = by_name.join(by_place, "tx_id")
    return both.select("tx_id", F.posexplode(F.concat("v", "w")).alias("position", "value"))


REPORT_SETS = ("Training", "Validation", "Test")
_REPORT_SQL = ", ".join(f"{S.r6(S.rates()[c])} AS {c}" for c in ("accuracy", "precision", "recall", "f1"))


@register("report_batches", "SNK-2,SNK-3,SET-3", with_ctes(TX_SQL, SCORES_SQL, f"""conf AS (
  SELECT batch, set_no, model, SUM((label = 0 AND pred = 0)::INT) AS tn, SUM((label = 0 AND pred = 1)::INT) AS fp,
         SUM((label = 1 AND pred = 0)::INT) AS fn, SUM((label = 1 AND pred = 1)::INT) AS tp
  FROM (SELECT *, tx_id % 2 + 1 AS batch, (tx_id // 2) % 3 AS set_no FROM scores) GROUP BY ALL)""", body=f"""
SELECT CAST(batch AS BIGINT) AS batch, ['Training', 'Validation', 'Test'][set_no + 1] AS "set", model, {_REPORT_SQL}
FROM conf"""))
def report_batches_df(spark, sf_dir):
    """Set x model reports of two runs as a log table and as a text log of batches; the first run is
    written twice, as after a failure. The text log is read back and must hold what the table holds."""
    from txscore.sources import logs as LG
    from txscore.sources.tables import score_table, tx_view
    rows = score_table(tx_view(spark, sf_dir)).withColumns({
        "batch": F.col("tx_id") % 2 + 1,
        "set": F.get(F.array(*[F.lit(x) for x in REPORT_SETS]), (F.expr("tx_id div 2") % 3).cast("int"))})
    counts = materialize(M.confusion(rows, ["batch", "set", "model"]))
    cols = ["accuracy", "precision", "recall", "f1"]
    rates = M.rate_columns(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    report = counts.select("batch", "set", "model", *[r6(rates[c]).alias(c) for c in cols])
    table, text = (IO.shared_path(spark, "reports") for _ in "ab")
    for run in (1, 1, 2):
        own = report.where(F.col("batch") == run).drop("batch")
        LG.write_run(own, table, f"run-{run}")
        LG.write_text_batch(own, text, f"run-{run}", ["set", "model"])
    read = LG.read_text_log(spark, text, "set string, model string, " + ", ".join(f"{c} double" for c in cols), header=False)
    run = F.regexp_extract("file", "run_id=run-([0-9]+)", 1).cast("long")
    lines = read.select(run.alias("batch"), "set", "model", *cols)
    logged = spark.read.parquet(table).select(F.regexp_extract("run_id", "([0-9]+)$", 1).cast("long").alias("batch"),
                                              "set", "model", *cols)
    return lines.intersectAll(logged)


@register("specificity_recovered", "PRJ-13", with_ctes(TX_SQL, SCORES_SQL, """conf AS (
  SELECT model, SUM((label = 0 AND pred = 0)::INT) AS tn, SUM((label = 0 AND pred = 1)::INT) AS fp FROM scores
  GROUP BY model)""", body=f"SELECT model, {S.r6(S.ratio('tn', 'tn + fp'))} AS specificity FROM conf"))
def specificity_recovered_df(spark, sf_dir):
    """Specificity from a report that has balanced accuracy and recall only."""
    from txscore.sources.tables import score_table, tx_view
    rep = M.metrics_report(score_table(tx_view(spark, sf_dir))).select("model", "balanced_accuracy", "recall")
    spec = M.specificity_from_balanced(F.col("balanced_accuracy"), F.col("recall"))
    return rep.select("model", r6(spec).alias("specificity"))


@register("parameter_cells", "SRC-3,SNK-4", with_ctes(TX_SQL, body=f"""
SELECT product, 'rule' AS criterion, NULL AS max_depth, CAST(COUNT(*) AS BIGINT) AS n_estimators,
       MAX(k) > 50 AS bootstrap, {S.r6('max(amt) / 1000')} AS learning_rate, CAST(5 AS BIGINT) AS n_params
FROM tx GROUP BY product"""))
def parameter_cells_df(spark, sf_dir):
    """Parameters of mixed types as one JSON cell of a log, written and read as a map."""
    from txscore.sources import logs as LG
    from txscore.sources.tables import tx_view
    path = IO.shared_path(spark, "parameters")
    per = tx_view(spark, sf_dir).groupBy("product").agg(
        F.count(F.lit(1)).alias("n_estimators"), (F.max("k") > 50).alias("bootstrap"),
        (F.max("amt") / 1000).alias("learning_rate"))
    cell = LG.params_cell("n_estimators", "bootstrap", "learning_rate", F.lit(None).cast("int").alias("max_depth"),
                          criterion="rule")
    LG.write_run(per.select("product", cell.alias("best_parameters")), path, "run-1")
    back = spark.read.parquet(path)
    return back.select("product", *[LG.param("best_parameters", n, t).alias(n) for n, t in (
        ("criterion", "string"), ("max_depth", "int"), ("n_estimators", "bigint"), ("bootstrap", "boolean"))],
        r6(LG.param("best_parameters", "learning_rate", "double")).alias("learning_rate"),
        F.size(LG.decode_params("best_parameters")).cast("long").alias("n_params"))


def append_report(report: DataFrame, path: str, run_id: str) -> None:
    """One run's rows (set, model, metrics) in the report table; a repeated run replaces its rows."""
    from txscore.sources import logs as LG
    LG.write_run(report, path, run_id)


@register("report_log", "SNK-2,SNK-3,SET-3")
def report_log_df(spark, sf_dir):
    """Two runs of the set x model report appended to one log and read back: the cross-
    validated report of the tuned candidates, then the hold-out rows of the six models."""
    path = IO.shared_path(spark, "report_log")
    cols = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
    tuned = list({f: (f, n, p) for f, n, p in reversed(GRID)}.values())  # each family's first
    cv = grid_search(spark, sf_dir, grid=tuned).where("selection = 'best_candidate'")
    append_report(cv.select("set", "model", *cols), path, "grid")
    test = M.metrics_report(model_scores(spark, sf_dir)).withColumn("set", F.lit("Test"))
    append_report(test.select("set", "model", *cols), path, "models")
    back = spark.read.parquet(path)
    return back.select("run_id", "set", "model", *[r6(c).alias(c) for c in cols])


def surrogate_rules_df(spark, sf_dir):
    """Depth-3 tree fit on the GNB model's predictions; per-leaf coverage,
    purity against those predictions, and overall fidelity."""
    train, test = _train_test(spark, sf_dir)
    gnb = GaussianNBModel.fit(train, GNB_FEATURES)
    target = gnb.transform(train).select(*GNB_FEATURES, F.col("pred").cast("double").alias("label"))
    tree = T.fit_pipeline(target, GNB_FEATURES, T.decision_tree(max_depth=3, impurity="gini")).stages[-1]
    rules = T.tree_rules(tree, GNB_FEATURES)
    leaf = F.lit(None).cast("int")
    for no, cond, _ in reversed(rules):
        leaf = F.when(F.expr(cond), F.lit(no)).otherwise(leaf)
    scored = gnb.transform(test).withColumn("leaf", leaf)
    cls = F.create_map(*[x for no, _, c in rules for x in (F.lit(no), F.lit(c))])
    per_leaf = scored.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("pred") == cls[F.col("leaf")]).cast("double")).alias("purity"))
    text = spark.createDataFrame([(no, cond, c) for no, cond, c in rules], "leaf int, rule string, class int")
    # rule text sink: one line per leaf, "<rule> => class <c>"
    IO.write_table(text.select(F.concat_ws(" => class ", "rule", F.col("class").cast("string")).alias("value")),
                   IO.shared_path(spark, "surrogate_rules"), fmt="text")
    out = text.join(per_leaf, "leaf", "left").select(
        "leaf", "rule", "class", F.coalesce("n", F.lit(0)).alias("n"), "purity")
    # fidelity: share of rows where the rule's class equals the explained model's prediction
    fidelity = F.sum(F.col("n") * F.coalesce("purity", F.lit(0.0))).over(Window.partitionBy()) / \
        F.sum("n").over(Window.partitionBy())     # one row per leaf (at most 8)
    return out.select("leaf", "rule", "class", "n", r6("purity").alias("purity"), r6(fidelity).alias("fidelity"))


register("surrogate_rules", "EXP-5,SNK-7")(surrogate_rules_df)


# ---- grid search ------------------------------------------------------------------

def grid_report(preds: DataFrame, refit: str = "f1") -> tuple[DataFrame, DataFrame]:
    """From predictions (model, candidate, cv, set, label, score, pred): the mean of every
    scorer over the folds by (model, candidate, set), and the candidate of each model with
    the best mean validation score of ``refit`` (ties: the smallest name)."""
    per_fold = M.fold_metrics(preds, ["model", "candidate", "cv", "set"])
    means = per_fold.groupBy("model", "candidate", "set").agg(
        *[F.avg(f()).alias(n) for n, f in SCORERS.items()])
    order = F.struct((-F.col(refit)).alias("s"), F.col("candidate").alias("c"))
    best = (means.where(F.col("set") == "Validation").groupBy("model")
            .agg(F.min_by("candidate", order).alias("candidate")))
    return means, best


def tuned_scores(train: DataFrame, test: DataFrame, params: dict[str, dict],
                 feats: list[str] = GNB_FEATURES) -> DataFrame:
    """(tx_id, label, model, score, pred) of the test rows by naive Bayes, nearest neighbours and the
    tree families of all train rows."""
    cols = ["tx_id", "label", "model", "score", "pred"]
    trees = {m: p for m, p in params.items() if m in E.FAMILIES}
    table = materialize(E.fit_table(E.fit_sample(train), feats, list(trees), trees))
    out = E.score_models(test, table, feats).select(*cols)
    nb = GaussianNBModel.fit(train, feats, **params["NaiveBayes"]).transform(test)
    ref = train.select(F.col("tx_id").alias("id"), "label", F.array(*feats).alias("vec"))
    near = knn_join(test.select(F.col("tx_id").alias("id"), F.array(*feats).alias("vec")), ref,
                    params["KNN"].get("n_neighbors", KNN_K), metric="l1")
    knn = (knn_classify(near, ref).join(test.select(F.col("tx_id").alias("q_id"), "label"), "q_id")
           .select(F.col("q_id").alias("tx_id"), "label", F.lit("KNN").alias("model"), "score", "pred"))
    return out.unionByName(nb.withColumn("model", F.lit("NaiveBayes")).select(*cols)).unionByName(knn)


def grid_search(spark, sf_dir, refit: str = "f1", n_folds: int = 10, grid=None) -> DataFrame:
    """All families' candidates (``GRID`` if not given) on all folds of the train part, whose rows
    all are fitted on and scored: for each model and set, every scorer's best mean over candidates (``per_metric_max``) and the
    means of the candidate chosen by ``refit`` (``best_candidate``)."""
    train, _ = _train_test(spark, sf_dir)
    folds = materialize(SM.stratified_folds(train, n_folds))
    grid = GRID if grid is None else grid
    preds = E.cross_validated(folds, GNB_FEATURES, grid, n_folds)  # read once, by the score summary
    means, best = grid_report(preds, refit)
    means = materialize(means)
    names = list(SCORERS)
    chosen = means.join(best, ["model", "candidate"]).withColumn("selection", F.lit("best_candidate"))
    maxima = means.groupBy("model", "set").agg(*[F.max(n).alias(n) for n in names]) \
        .withColumns({"selection": F.lit("per_metric_max"), "candidate": F.lit(None).cast("string")})
    # the chosen candidates, fitted on the whole train part, on the test part
    params = {(f, n): p for f, n, p in grid}
    _, test = _train_test(spark, sf_dir)
    final = {r.model: (r.candidate, params[r.model, r.candidate]) for r in best.collect()}  # one row a model
    tested = M.metrics_report(tuned_scores(folds.drop("fold"), test, {m: p for m, (_, p) in final.items()}))
    name = F.create_map(*[x for m, (c, _) in final.items() for x in (F.lit(m), F.lit(c))])
    tested = tested.select("*", F.lit("Test").alias("set"), F.lit("best_candidate").alias("selection"),
                           name[F.col("model")].alias("candidate"))
    tested = tested.select("model", "set", "selection", "candidate", *[f().alias(n) for n, f in SCORERS.items()])
    cols = ["model", "set", "selection", "candidate", *names]
    maxima = maxima.unionByName(tested)
    return chosen.select(*cols).unionByName(maxima.select(*cols))


def grid_search_report_df(spark, sf_dir):
    rep = grid_search(spark, sf_dir)
    spec = M.specificity_from_balanced(F.col("balanced_accuracy"), F.col("recall"))
    return rep.select("set", "selection", "model", "candidate", *[r6(c).alias(c) for c in [
        "accuracy", "balanced_accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]],
        r6(spec).alias("specificity"))


register("grid_search_report", "MDL-8,AGG-8,AGG-9,SET-3,PRJ-13,UDF-2")(grid_search_report_df)


def grid_best_candidate_df(spark, sf_dir):
    """Candidates = the rule scorers, scored on 10 folds: mean per (metric,
    candidate), best mean per metric and the candidate holding it."""
    fs = cv_fold_scores(spark, sf_dir)
    means = fs.groupBy("metric", "model").agg(F.avg("score").alias("mean_score"))
    best = means.groupBy("metric").agg(
        F.max("mean_score").alias("best_mean"),
        F.min_by("model", F.struct((-F.col("mean_score")).alias("s"), F.col("model").alias("m")))
        .alias("best_candidate"))
    return best.select("metric", r6("best_mean").alias("best_mean"), "best_candidate")


register("grid_best_candidate", "AGG-8,AGG-9,MDL-8", with_ctes(
    TX_SQL, SCORES_SQL, FOLD_SCORES_SQL, """means AS (SELECT metric, model, avg(score) AS m FROM fs GROUP BY metric, model),
best AS (SELECT metric, model, m, ROW_NUMBER() OVER (PARTITION BY metric ORDER BY m DESC, model) AS rn FROM means)""",
    body=f"SELECT metric, {S.r6('m')} AS best_mean, model AS best_candidate FROM best WHERE rn = 1"))(
    grid_best_candidate_df)


# ---- cross-validated comparison with oversampling inside the folds --------------

def cv_model_scores(spark, sf_dir, n_folds: int = 10) -> DataFrame:
    """(metric, model, fold, score) of the six tuned models for every scorer, measured on all rows
    of the train part. Each fold's training rows alone are oversampled (ratio 0.20) and fitted on."""
    train, _ = _train_test(spark, sf_dir)
    folds = materialize(SM.stratified_folds(train, n_folds))
    preds = E.cross_validated(folds, GNB_FEATURES, [(m, "tuned", {}) for m in MODELS], n_folds,
                              ratio=SMOTE_RATIO, training=False)
    m = M.fold_metrics(preds, ["model", "cv"])
    long = m.select("model", F.col("cv").alias("fold"), *[f().cast("double").alias(n) for n, f in SCORERS.items()])
    return long.unpivot(["model", "fold"], list(SCORERS), "metric", "score")


def cv_model_scores_df(spark, sf_dir):
    return cv_model_scores(spark, sf_dir).select("metric", "model", "fold", r6("score").alias("score"))


register("cv_model_scores", "MDL-10,SMP-3,SMP-6")(cv_model_scores_df)


def shapley_sampled_df(spark, sf_dir):
    """Permutation-sampled Shapley values of the fitted GNB's P(fraud) for every
    test row (8 features, 16 seeded feature orders, 50-row training background)."""
    from txscore.operators import explain as X
    train, test = _train_test(spark, sf_dir)
    model = GaussianNBModel.fit(train, GNB_FEATURES)
    d = len(GNB_FEATURES)
    phi = X.shapley_values(test, SM.background_sample(train), GNB_FEATURES, model.predictor(),
                           X.sampled_coalitions(d, X.sampled_permutations(d, 16)))
    return phi.select("tx_id", "feature", r6("phi").alias("phi"))


register("shapley_sampled", "EXP-3,EXP-6,UDF-3")(shapley_sampled_df)


@register("shapley_boosted", "EXP-4,UDF-3")
def shapley_boosted_df(spark, sf_dir):
    """Every test record explained for the boosted trees over all prepared features: the exact
    values of the decision against a background of 50 train rows; the 14 largest of each."""
    from txscore.operators.tree_shapley import top_of_record, tree_shapley
    from txscore.plans.streams import TOP_SHOWN
    train, test, feats = prepared_split(spark, sf_dir)
    model = E.load_models(E.fit_table(E.fit_sample(train), feats, ["XGBoost"]))["XGBoost",]
    phi = tree_shapley(test, SM.background_sample(train), feats, model)
    return top_of_record(phi, TOP_SHOWN).select("tx_id", "feature", r6("phi").alias("phi"), "rank")


@register("permutation_importance_boosted", "EXP-2")
def permutation_importance_boosted_df(spark, sf_dir):
    """Accuracy that the fitted boosted trees lose on the test part without each feature, the 20
    largest."""
    from txscore.operators import explain as X
    train, test, feats = prepared_split(spark, sf_dir)
    model = E.load_models(E.fit_table(E.fit_sample(train), feats, ["XGBoost"]))["XGBoost",]
    imp = X.permutation_importance(test, feats, lambda x: E.probability("XGBoost", model, x)[1])
    return X.top_importances(imp, "importance_mean").select("feature", *[r6(c).alias(c) for c in (
        "importance_mean", "importance_std")])
