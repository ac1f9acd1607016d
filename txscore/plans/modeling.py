"""Model queries: exact kNN join and distance-weighted kNN scores, SMOTE
neighbours / counts / rows, Gaussian naive Bayes fit and scores, majority vote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.functions.algebra import r6
from txscore.functions.hashing import hash_sql, uniform_sql
from txscore.operators import sampling as SM
from txscore.operators.bayes import VAR_SMOOTHING, GaussianNBModel, gnb_fit_table
from txscore.operators.neighbors import knn_classify, knn_join
from txscore.operators.smote import SMOTE_K, smote
from txscore.operators.vote import majority_vote
from txscore.plans import preparation as PP
from txscore.plans import sqlkit as S
from txscore.plans.registry import CATALOG, register
from txscore.sources.tables import SCORES_SQL, TX_SQL, read_table, score_table, tx_view, with_ctes

KNN_K = 3            # fixed value of the tuned classifier (3 neighbours, L1, distance weights)
SMOTE_RATIO = 0.20   # minority / majority after oversampling


def embedding_split(spark, sf_dir) -> DataFrame:
    """embeddings with a binary label (class 0 is the minority positive) and a
    stratified 75/25 split."""
    emb = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"),
        F.when(F.col("label") == 0, 1).otherwise(0).alias("label"))
    return SM.stratified_split(emb, id_col="id")


_EH = hash_sql("vec_id")
EMB_SQL = f"""emb AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y FROM embeddings),
esplit AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY y ORDER BY {_EH}, vec_id)
                      <= round(0.25 * COUNT(*) OVER (PARTITION BY y)) THEN 'test' ELSE 'train' END AS part
  FROM emb)"""


def _l1(a: str, b: str) -> str:
    return f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: abs({a}[i] - {b}[i])), lambda x, y: x + y)"


def _l2(a: str, b: str) -> str:
    return (f"sqrt(list_reduce(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])),"
            f" lambda x, y: x + y))")


KNN_SQL = f"""pairs AS (
  SELECT q.vec_id AS q_id, r.vec_id AS r_id, {_l1('q.v', 'r.v')} AS dist
  FROM esplit q JOIN esplit r ON q.part = 'test' AND r.part = 'train'),
nn AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY q_id ORDER BY dist, r_id) AS rank FROM pairs)
  WHERE rank <= {KNN_K})"""


def _knn(spark, sf_dir):
    sp = embedding_split(spark, sf_dir)
    test, train = sp.where(F.col("part") == "test"), sp.where(F.col("part") == "train")
    return knn_join(test, train, KNN_K, metric="l1"), train


def knn_neighbors_df(spark, sf_dir):
    nn, _ = _knn(spark, sf_dir)
    return nn.select("q_id", "r_id", F.col("rank").cast("long").alias("rank"), r6("dist").alias("dist"))


register("knn_neighbors", "JN-6", with_ctes(
    EMB_SQL, KNN_SQL, body=f"SELECT q_id, r_id, CAST(rank AS BIGINT) AS rank, {S.r6('dist')} AS dist FROM nn"))(
    knn_neighbors_df)


def knn_scores_df(spark, sf_dir):
    nn, train = _knn(spark, sf_dir)
    sc = knn_classify(nn, train, r_id="id")
    return sc.select(F.col("q_id").alias("vec_id"), r6("score").alias("score"), "pred")


register("knn_scores", "MDL-1,MDL-9,JN-6", with_ctes(
    EMB_SQL, KNN_SQL, """kv AS (
  SELECT n.q_id, n.dist, e.y FROM nn n JOIN esplit e ON e.vec_id = n.r_id),
ks AS (
  SELECT q_id,
         SUM(CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END) AS nz,
         SUM(CASE WHEN dist = 0 AND y = 1 THEN 1.0 ELSE 0.0 END) AS nz1,
         SUM(CASE WHEN dist <> 0 THEN 1.0 / dist END) AS w,
         SUM(CASE WHEN dist <> 0 AND y = 1 THEN 1.0 / dist END) AS w1
  FROM kv GROUP BY q_id),
kp AS (SELECT q_id, CASE WHEN nz > 0 THEN nz1 / nz ELSE coalesce(w1, 0.0) / w END AS score FROM ks)""",
    body=f"SELECT q_id AS vec_id, {S.r6('score')} AS score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM kp"))(
    knn_scores_df)


# ---- SMOTE ---------------------------------------------------------------------

SMOTE_BASE_SQL = f"""mino AS (SELECT vec_id AS id, v FROM esplit WHERE part = 'train' AND y = 1),
cnt AS (
  SELECT SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS n_maj, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS n_min
  FROM esplit WHERE part = 'train'),
snn AS (
  SELECT * FROM (
    SELECT q.id AS q_id, r.id AS r_id, {_l2('q.v', 'r.v')} AS dist,
           ROW_NUMBER() OVER (PARTITION BY q.id ORDER BY {_l2('q.v', 'r.v')}, r.id) AS rank
    FROM mino q JOIN mino r ON q.id <> r.id)
  WHERE rank <= {SMOTE_K})"""


def _smote_input(spark, sf_dir):
    sp = embedding_split(spark, sf_dir)
    return sp.where(F.col("part") == "train").select("id", "vec", "label")


def smote_neighbors_df(spark, sf_dir):
    tr = _smote_input(spark, sf_dir)
    mino = tr.where(F.col("label") == 1)
    nn = knn_join(mino, mino, SMOTE_K, metric="l2", exclude_self=True)
    return nn.select(F.col("q_id").alias("id"), F.col("r_id").alias("neighbor_id"),
                     F.col("rank").cast("long").alias("rank"), r6("dist").alias("dist"))


register("smote_neighbors", "JN-5", with_ctes(
    EMB_SQL, SMOTE_BASE_SQL,
    body=f"SELECT q_id AS id, r_id AS neighbor_id, CAST(rank AS BIGINT) AS rank, {S.r6('dist')} AS dist FROM snn"))(
    smote_neighbors_df)


def smote_counts_df(spark, sf_dir):
    bal = smote(_smote_input(spark, sf_dir), ratio=SMOTE_RATIO, metric="l2")
    return bal.groupBy("label", "is_synthetic").agg(F.count(F.lit(1)).alias("n"))


register("smote_counts", "SMP-6,AGG-7", with_ctes(
    EMB_SQL, """cnt AS (
  SELECT SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS n_maj, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS n_min
  FROM esplit WHERE part = 'train')""",
    body=f"""SELECT y AS label, false AS is_synthetic, COUNT(*) AS n FROM esplit WHERE part = 'train' GROUP BY y
UNION ALL
SELECT 1, true, CAST(greatest(0, floor({SMOTE_RATIO!r}::DOUBLE * n_maj - n_min)) AS BIGINT) FROM cnt
WHERE greatest(0, floor({SMOTE_RATIO!r}::DOUBLE * n_maj - n_min)) > 0"""))(smote_counts_df)


def smote_rows_df(spark, sf_dir):
    bal = smote(_smote_input(spark, sf_dir), ratio=SMOTE_RATIO, metric="l2")
    vsum = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return bal.select("id", "label", "is_synthetic", "base_id", "neighbor_id", r6("gap").alias("gap"),
                      r6(vsum).alias("v_sum"), r6(F.col("vec")[0]).alias("v0"))


_SH = hash_sql("id", 42, "s")
register("smote_rows", "SMP-6,SET-2,JN-5", with_ctes(
    EMB_SQL, SMOTE_BASE_SQL, f"""nnew AS (SELECT CAST(greatest(0, floor({SMOTE_RATIO!r}::DOUBLE * n_maj - n_min)) AS BIGINT) AS n_new, n_min FROM cnt),
rk AS (SELECT id, v, ROW_NUMBER() OVER (ORDER BY {hash_sql('id')}, id) AS i FROM mino),
seeds AS (
  SELECT rk.id, rk.v, rk.i, c.c, c.c * nnew.n_min + rk.i - 1 AS s
  FROM rk, nnew, LATERAL (SELECT unnest(range(CAST(0 AS BIGINT), CAST(n_new // n_min + CASE WHEN rk.i <= n_new % n_min THEN 1 ELSE 0 END AS BIGINT))) AS c) c),
drawn AS (
  SELECT *, (CAST(('0x' || substr({_SH}, 9, 8)) AS BIGINT) % {SMOTE_K}) + 1 AS slot, {uniform_sql(_SH)} AS gap FROM seeds),
synth AS (
  SELECT -(d.s + 1) AS id, 1 AS label, true AS is_synthetic, d.id AS base_id, n.r_id AS neighbor_id, d.gap,
         list_transform(range(1, len(d.v) + 1), lambda j: d.v[j] + d.gap * (m.v[j] - d.v[j])) AS vec
  FROM drawn d JOIN snn n ON n.q_id = d.id AND n.rank = d.slot JOIN mino m ON m.id = n.r_id),
allr AS (
  SELECT vec_id AS id, y AS label, false AS is_synthetic, CAST(NULL AS BIGINT) AS base_id,
         CAST(NULL AS BIGINT) AS neighbor_id, CAST(NULL AS DOUBLE) AS gap, v AS vec
  FROM esplit WHERE part = 'train'
  UNION ALL SELECT * FROM synth)""",
    body=f"""SELECT id, label, is_synthetic, base_id, neighbor_id, {S.r6('gap')} AS gap,
       {S.r6('list_reduce(vec, lambda x, y: x + y)')} AS v_sum, {S.r6('vec[1]')} AS v0 FROM allr"""))(smote_rows_df)


# ---- Gaussian naive Bayes -------------------------------------------------------

GNB_FEATURES = [f"num__{c}" for c in PP._KEPT_NUMS]


def scaled_split(spark, sf_dir) -> DataFrame:
    """The transaction split with imputed, robust-scaled numerics (num__*)."""
    sp, train, _, nums, fills, summary = PP._fitted(spark, sf_dir)
    from txscore.operators import prep as P
    rob = {r["feature"]: r for r in P.robust_table(train, nums, summary=summary).collect()}
    return sp.select("tx_id", "part", "label", *[
        ((F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c]))) - F.lit(float(rob[c]["center"])))
         / F.lit(float(rob[c]["scale"]))).alias(f"num__{c}") for c in nums])


SCALED_SQL = ("sc AS (SELECT tx_id, part, label, "
              + ", ".join(f"{PP._scaled_sql(c)} AS num__{c}" for c in PP._KEPT_NUMS) + " FROM split)")
GNB_SQL = f"""trn AS (SELECT * FROM sc WHERE part = 'train'),
eps AS (SELECT greatest({', '.join(f'var_pop({f})' for f in GNB_FEATURES)}) * {VAR_SMOOTHING!r} AS eps FROM trn),
tl AS (UNPIVOT (SELECT label, {', '.join(GNB_FEATURES)} FROM trn) ON {', '.join(GNB_FEATURES)} INTO NAME feature VALUE x),
gp AS (SELECT label, feature, avg(x) AS mean, var_pop(x) + (SELECT eps FROM eps) AS var FROM tl GROUP BY label, feature),
pri AS (SELECT label, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM trn) AS prior FROM trn GROUP BY label)"""


def gnb_fit_df(spark, sf_dir):
    sc = scaled_split(spark, sf_dir)
    fit = gnb_fit_table(sc.where(F.col("part") == "train"), GNB_FEATURES)
    return fit.select("label", "feature", r6("prior").alias("prior"), r6("mean").alias("mean"),
                      r6("var").alias("var"))


register("gnb_fit", "MDL-2", with_ctes(
    *PP.BASE, PP.NULLRATE_SQL, PP.FILL_SQL, PP.ROBUST_SQL, SCALED_SQL, GNB_SQL,
    body=f"""SELECT g.label, g.feature, {S.r6('p.prior')} AS prior, {S.r6('g.mean')} AS mean, {S.r6('g.var')} AS var
FROM gp g JOIN pri p ON p.label = g.label"""))(gnb_fit_df)


def gnb_scores_df(spark, sf_dir):
    sc = scaled_split(spark, sf_dir)
    model = GaussianNBModel.fit(sc.where(F.col("part") == "train"), GNB_FEATURES)
    out = model.transform(sc.where(F.col("part") == "test"))
    return out.select("tx_id", "label", r6("score").alias("score"), "pred")


register("gnb_scores", "MDL-2,MDL-9", with_ctes(
    *PP.BASE, PP.NULLRATE_SQL, PP.FILL_SQL, PP.ROBUST_SQL, SCALED_SQL, GNB_SQL,
    f"""tsl AS (UNPIVOT (SELECT tx_id, label, {', '.join(GNB_FEATURES)} FROM sc WHERE part = 'test')
        ON {', '.join(GNB_FEATURES)} INTO NAME feature VALUE x),
jll AS (
  SELECT t.tx_id, t.label AS y, g.label AS c,
         ln(p.prior) - 0.5 * SUM(ln(2.0 * pi() * g.var)) - 0.5 * SUM((t.x - g.mean) * (t.x - g.mean) / g.var) AS j
  FROM tsl t JOIN gp g ON g.feature = t.feature JOIN pri p ON p.label = g.label
  GROUP BY t.tx_id, t.label, g.label, p.prior),
gs AS (
  SELECT tx_id, y AS label,
         1.0 / (1.0 + exp(MAX(CASE WHEN c = 0 THEN j END) - MAX(CASE WHEN c = 1 THEN j END))) AS score
  FROM jll GROUP BY tx_id, y)""",
    body=f"SELECT tx_id, label, {S.r6('score')} AS score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM gs"))(
    gnb_scores_df)


# ---- vote ------------------------------------------------------------------------

def majority_vote_df(spark, sf_dir):
    return majority_vote(score_table(tx_view(spark, sf_dir)))


register("majority_vote", "AGG-11,PRJ-12", with_ctes(
    TX_SQL, SCORES_SQL, body="""SELECT tx_id, CAST(SUM(pred) AS BIGINT) AS fraud_votes,
       CAST(COUNT(*) - SUM(pred) AS BIGINT) AS legit_votes,
       CASE WHEN SUM(pred) > COUNT(*) - SUM(pred) THEN 'Fraudulent' ELSE 'Legitimate' END AS verdict
FROM scores GROUP BY tx_id"""))(majority_vote_df)


# ---- persisted model ----------------------------------------------------------

def gnb_persisted_scores_df(spark, sf_dir):
    """Fit, persist the parameter table to the shared folder, reload it in a
    fresh model object, score the test rows (same result as ``gnb_scores``)."""
    from txscore.sources import io as IO
    sc = scaled_split(spark, sf_dir)
    path = IO.shared_path(spark, "models", "NaiveBayes")
    IO.save_params(gnb_fit_table(sc.where(F.col("part") == "train"), GNB_FEATURES), path)
    model = GaussianNBModel.from_table(IO.load_params(spark, path), GNB_FEATURES)
    out = model.transform(sc.where(F.col("part") == "test"))
    return out.select("tx_id", "label", r6("score").alias("score"), "pred")


register("gnb_persisted_scores", "SNK-6,SRC-4,MDL-9", CATALOG["gnb_scores"].sql)(gnb_persisted_scores_df)


@register("knn_lsh_neighbors", "JN-5")
def knn_lsh_neighbors_df(spark, sf_dir):
    """Near neighbours of the held-out vectors by p-stable projections (approximate; exact distances)."""
    from txscore.operators.lsh_neighbors import lsh_knn_join
    sp = embedding_split(spark, sf_dir)
    out = lsh_knn_join(sp.where(F.col("part") == "test"), sp.where(F.col("part") == "train"), KNN_K, metric="l1")
    return out.select("q_id", "r_id", r6("dist").alias("dist"), F.col("rank").cast("long").alias("rank"))
