"""Preparation queries over the transaction view: cleaning, time features,
null pruning, split / folds, imputation, robust scaling, one-hot survivors,
variance filter, mutual information and top-k selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.functions.algebra import r6
from txscore.functions.hashing import hash_sql
from txscore.operators import prep as P
from txscore.operators import sampling as SM
from txscore.plans import sqlkit as S
from txscore.plans.registry import register
from txscore.session import materialize
from txscore.sources.tables import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TX_SQL, tx_view, with_ctes

CATS = list(CATEGORICAL_FEATURES)
NUMS = list(NUMERIC_FEATURES) + P.TEMPORAL_FEATURES
TOP_K = 12  # top-k size for the catalogue run (this view has ~20 prepared features)


def clean_tx(spark, sf_dir) -> DataFrame:
    """tx with blank text -> NULL and the derived time columns."""
    return P.with_temporal(P.clean_strings(tx_view(spark, sf_dir), CATS))


def split_tx(spark, sf_dir) -> DataFrame:
    """The cleaned view with its train/test flag, written once (it feeds several fits)."""
    return materialize(SM.stratified_split(clean_tx(spark, sf_dir)))


# ---- SQL building blocks ------------------------------------------------------

_H = hash_sql("tx_id")
CLEAN_SQL = """clean AS (
  SELECT tx_id, dt, amt, product, card,
         CASE WHEN regexp_matches(email, '^\\s*$') THEN NULL ELSE email END AS email,
         k, d1, v_sparse, label
  FROM tx)"""
FEAT_SQL = """feat AS (
  SELECT *, dt / 86400.0::DOUBLE AS days,
         sin(2.0::DOUBLE * pi() * hour / 24.0::DOUBLE) AS hour_sin,
         cos(2.0::DOUBLE * pi() * hour / 24.0::DOUBLE) AS hour_cos,
         sin(2.0::DOUBLE * pi() * dow / 7.0::DOUBLE) AS dow_sin,
         cos(2.0::DOUBLE * pi() * dow / 7.0::DOUBLE) AS dow_cos
  FROM (SELECT *, ((floor(dt / 3600.0::DOUBLE) % 24) + 24) % 24 AS hour,
               ((floor(dt / 86400.0::DOUBLE) % 7) + 7) % 7 AS dow FROM clean))"""
SPLIT_SQL = f"""split AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_H}, tx_id)
                      <= round(0.25 * COUNT(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS part
  FROM feat)"""
TRAIN_SQL = "train AS (SELECT * FROM split WHERE part = 'train')"
BASE = [TX_SQL, CLEAN_SQL, FEAT_SQL, SPLIT_SQL, TRAIN_SQL]

_FEATS = CATS + NUMS
NULLRATE_SQL = ("nr AS (SELECT feature, null_rate, null_rate < 0.9 AS kept FROM (UNPIVOT (SELECT "
                + ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS {c}" for c in _FEATS)
                + " FROM feat) ON " + ", ".join(_FEATS) + " INTO NAME feature VALUE null_rate))")
_cat_long = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM train" for c in CATS)
_num_long = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM train" for c in NUMS)
FILL_SQL = f"""catl AS ({_cat_long}),
numl AS ({_num_long}),
modes AS (
  SELECT feature, value AS fill_cat FROM (
    SELECT feature, value, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY cnt DESC, value) AS rn
    FROM (SELECT feature, value, COUNT(*) AS cnt FROM catl WHERE value IS NOT NULL GROUP BY feature, value))
  WHERE rn = 1),
meds AS (SELECT feature, quantile_cont(value, 0.5) AS fill_num FROM numl WHERE value IS NOT NULL GROUP BY feature),
fills AS (
  SELECT m.feature, 'cat' AS role, CAST(NULL AS DOUBLE) AS fill_num, m.fill_cat FROM modes m JOIN nr USING (feature) WHERE nr.kept
  UNION ALL
  SELECT d.feature, 'num', d.fill_num, CAST(NULL AS VARCHAR) FROM meds d JOIN nr USING (feature) WHERE nr.kept)"""
ROBUST_SQL = """rob AS (
  SELECT l.feature, f.fill_num AS center,
         quantile_cont(coalesce(l.value, f.fill_num), 0.25) AS q25,
         quantile_cont(coalesce(l.value, f.fill_num), 0.75) AS q75
  FROM numl l JOIN fills f ON f.feature = l.feature AND f.role = 'num'
  GROUP BY l.feature, f.fill_num),
robs AS (SELECT *, CASE WHEN q75 - q25 = 0 THEN 1.0 ELSE q75 - q25 END AS scale FROM rob)"""


def _fill(c: str) -> str:
    kind = "fill_cat" if c in CATS else "fill_num"
    return f"(SELECT {kind} FROM fills WHERE feature = '{c}')"


# ---- queries ------------------------------------------------------------------

def temporal_features_df(spark, sf_dir):
    tx = tx_view(spark, sf_dir)
    cols = P.temporal_columns(F.col("dt"))
    return tx.select("tx_id", r6(cols["days"], 9).alias("days"), cols["hour"].alias("hour"),
                     cols["dow"].alias("dow"),
                     *[r6(cols[c]).alias(c) for c in ("hour_sin", "hour_cos", "dow_sin", "dow_cos")])


register("temporal_features", "PRJ-3,PRJ-4,PRJ-5,PRJ-6", with_ctes(
    TX_SQL, CLEAN_SQL, FEAT_SQL,
    body=f"""SELECT tx_id, {S.r6('days', 9)} AS days, CAST(hour AS BIGINT) AS hour, CAST(dow AS BIGINT) AS dow,
       {S.r6('hour_sin')} AS hour_sin, {S.r6('hour_cos')} AS hour_cos,
       {S.r6('dow_sin')} AS dow_sin, {S.r6('dow_cos')} AS dow_cos FROM feat"""))(temporal_features_df)


def blank_to_null_cast_df(spark, sf_dir):
    tx = tx_view(spark, sf_dir)
    # the record as delimited text: every field a string, codes in two spellings
    text = tx.select(
        "tx_id", F.col("product"),
        F.when(F.col("tx_id") % 2 == 0, F.concat(F.col("card"), F.lit(".0"))).otherwise(F.col("card")).alias("card"),
        F.col("email"), F.col("amt").cast("string").alias("amt"), F.col("k").cast("string").alias("k"))
    return text.select(
        "tx_id", P.blank_to_null(F.col("product")).alias("product"),
        P.canonical_code(P.blank_to_null(F.col("card"))).alias("card"),
        P.canonical_code(P.blank_to_null(F.col("email"))).alias("email"),
        P.soft_double(F.col("amt")).alias("amt"), P.soft_double(F.col("k")).alias("k"),
        P.soft_double(F.col("email")).alias("email_num"))


def _canon_sql(c: str) -> str:
    t = f"TRY_CAST({c} AS DOUBLE)"
    return (f"CASE WHEN {t} IS NOT NULL AND {t} = floor({t}) AND abs({t}) < 1e15 "
            f"THEN CAST(CAST(floor({t}) AS BIGINT) AS VARCHAR) ELSE {c} END")


def _blank_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^\\s*$') THEN NULL ELSE {c} END"


register("blank_to_null_cast", "PRJ-7,PRJ-8,STR-4", with_ctes(
    TX_SQL, f"""txt AS (
  SELECT tx_id, product,
         CASE WHEN tx_id % 2 = 0 THEN card || '.0' ELSE card END AS card,
         email, CAST(amt AS VARCHAR) AS amt, CAST(k AS VARCHAR) AS k FROM tx)""",
    body=f"""SELECT tx_id, {_blank_sql('product')} AS product, {_canon_sql(_blank_sql('card'))} AS card,
       {_canon_sql(_blank_sql('email'))} AS email, TRY_CAST(amt AS DOUBLE) AS amt,
       TRY_CAST(k AS DOUBLE) AS k, TRY_CAST(email AS DOUBLE) AS email_num FROM txt"""))(blank_to_null_cast_df)


def null_rates_df(spark, sf_dir):
    rates = P.kept_by_null_rate(P.null_rates(clean_tx(spark, sf_dir), _FEATS))
    return rates.select("feature", r6("null_rate").alias("null_rate"), "kept")


register("null_rates", "PRJ-9,PRJ-1,PRJ-2", with_ctes(
    TX_SQL, CLEAN_SQL, FEAT_SQL, NULLRATE_SQL,
    body=f"SELECT feature, {S.r6('null_rate')} AS null_rate, kept FROM nr"))(null_rates_df)


def stratified_split_df(spark, sf_dir):
    return split_tx(spark, sf_dir).select("tx_id", "label", "part")


register("stratified_split", "SMP-1", with_ctes(
    *BASE[:4], body="SELECT tx_id, label, part FROM split"))(stratified_split_df)


def class_counts_df(spark, sf_dir):
    return split_tx(spark, sf_dir).groupBy("part", "label").agg(F.count(F.lit(1)).alias("n"))


register("class_counts", "AGG-7", with_ctes(
    *BASE[:4], body="SELECT part, label, COUNT(*) AS n FROM split GROUP BY part, label"))(class_counts_df)


def stratified_folds_df(spark, sf_dir):
    train = split_tx(spark, sf_dir).where(F.col("part") == "train")
    return SM.stratified_folds(train).select("tx_id", "label", "fold")


register("stratified_folds", "SMP-2", with_ctes(
    *BASE, body=f"""SELECT tx_id, label,
       CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_H}, tx_id) - 1) % 10 AS INTEGER) AS fold
FROM train"""))(stratified_folds_df)


def _kept_features(spark, sf_dir, df):
    rates = P.kept_by_null_rate(P.null_rates(df, _FEATS))
    kept = {r["feature"] for r in rates.where("kept").collect()}
    return [c for c in CATS if c in kept], [c for c in NUMS if c in kept]


def impute_fit_df(spark, sf_dir):
    sp = split_tx(spark, sf_dir)
    cats, nums = _kept_features(spark, sf_dir, sp)
    fills = P.fill_table(sp.where(F.col("part") == "train"), cats, nums)
    return fills.select("feature", "role", r6("fill_num").alias("fill_num"), "fill_cat")


register("impute_fit", "AGG-1,AGG-2,PRJ-9", with_ctes(
    *BASE, NULLRATE_SQL, FILL_SQL,
    body=f"SELECT feature, role, {S.r6('fill_num')} AS fill_num, fill_cat FROM fills"))(impute_fit_df)


def _fitted(spark, sf_dir):
    """Split, kept columns, fill values and the numeric summary (median and
    imputed quartiles from one cumulative table)."""
    sp = split_tx(spark, sf_dir)
    cats, nums = _kept_features(spark, sf_dir, sp)
    train = sp.where(F.col("part") == "train")
    summary = P.numeric_summary(train, nums)
    fills = {r["feature"]: (r["fill_cat"] if r["role"] == "cat" else r["fill_num"])
             for r in P.fill_table(train, cats, nums, summary=summary).collect()}
    return sp, train, cats, nums, fills, summary


def impute_apply_df(spark, sf_dir):
    sp, _, cats, nums, fills, _ = _fitted(spark, sf_dir)
    return sp.select("tx_id", "part",
                     *[F.coalesce(F.col(c), F.lit(fills[c])).alias(c) for c in cats],
                     *[r6(F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c]))), 9).alias(c) for c in nums])


_KEPT_CATS = ["product", "card", "email"]
_KEPT_NUMS = [c for c in NUMS if c != "v_sparse"]
register("impute_apply", "AGG-1,AGG-2,JN-1", with_ctes(
    *BASE, NULLRATE_SQL, FILL_SQL,
    body="SELECT tx_id, part, "
    + ", ".join(f"coalesce({c}, {_fill(c)}) AS {c}" for c in _KEPT_CATS) + ", "
    + ", ".join(f"{S.r6(f'coalesce(CAST({c} AS DOUBLE), {_fill(c)})', 9)} AS {c}" for c in _KEPT_NUMS)
    + " FROM split"))(impute_apply_df)


def robust_scale_fit_df(spark, sf_dir):
    _, train, _, nums, fills, summary = _fitted(spark, sf_dir)
    rob = P.robust_table(train, nums, summary=summary)
    return rob.select("feature", *[r6(c).alias(c) for c in ("center", "q25", "q75", "scale")])


register("robust_scale_fit", "AGG-3", with_ctes(
    *BASE, NULLRATE_SQL, FILL_SQL, ROBUST_SQL,
    body=f"SELECT feature, {S.r6('center')} AS center, {S.r6('q25')} AS q25, {S.r6('q75')} AS q75, "
         f"{S.r6('scale')} AS scale FROM robs"))(robust_scale_fit_df)


def robust_scale_df(spark, sf_dir):
    sp, train, _, nums, fills, summary = _fitted(spark, sf_dir)
    rob = {r["feature"]: r for r in P.robust_table(train, nums, summary=summary).collect()}
    return sp.select("tx_id", "part", *[
        r6((F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c]))) - F.lit(float(rob[c]["center"])))
           / F.lit(float(rob[c]["scale"]))).alias(f"num__{c}") for c in nums])


def _scaled_sql(c: str) -> str:
    return (f"(coalesce(CAST({c} AS DOUBLE), (SELECT center FROM robs WHERE feature = '{c}')) - "
            f"(SELECT center FROM robs WHERE feature = '{c}')) / (SELECT scale FROM robs WHERE feature = '{c}')")


register("robust_scale", "AGG-3", with_ctes(
    *BASE, NULLRATE_SQL, FILL_SQL, ROBUST_SQL,
    body="SELECT tx_id, part, " + ", ".join(f"{S.r6(_scaled_sql(c))} AS num__{c}" for c in _KEPT_NUMS)
    + " FROM split"))(robust_scale_df)


def _imputed_train(spark, sf_dir):
    sp, train, cats, nums, fills, summary = _fitted(spark, sf_dir)
    imp = train.select("tx_id", "label",
                       *[F.coalesce(F.col(c), F.lit(fills[c])).alias(c) for c in cats],
                       *[F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c]))).alias(c) for c in nums])
    return sp, imp, cats, nums, fills, summary


def onehot_survivors_df(spark, sf_dir):
    _, imp, cats, _, _, _ = _imputed_train(spark, sf_dir)
    sh = P.category_shares(imp, cats)
    return sh.select("feature", "value", "n", r6("p").alias("p"), r6("variance").alias("variance"), "kept")


SHARES_SQL = """impc AS (
  SELECT 'product' AS feature, coalesce(product, (SELECT fill_cat FROM fills WHERE feature = 'product')) AS value FROM train
  UNION ALL SELECT 'card', coalesce(card, (SELECT fill_cat FROM fills WHERE feature = 'card')) FROM train
  UNION ALL SELECT 'email', coalesce(email, (SELECT fill_cat FROM fills WHERE feature = 'email')) FROM train),
shares AS (
  SELECT feature, value, n, p, p * (1.0 - p) AS variance, p * (1.0 - p) > 0.05 AS kept
  FROM (SELECT feature, value, COUNT(*) AS n,
               CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY feature) AS p
        FROM impc GROUP BY feature, value))"""

register("onehot_survivors", "AGG-4,AGG-5", with_ctes(
    *BASE, NULLRATE_SQL, FILL_SQL, SHARES_SQL,
    body=f"SELECT feature, value, n, {S.r6('p')} AS p, {S.r6('variance')} AS variance, kept FROM shares"))(
    onehot_survivors_df)


def onehot_long_df(spark, sf_dir):
    sp, imp, cats, _, fills, _ = _imputed_train(spark, sf_dir)
    surv = P.category_shares(imp, cats).where("kept").select("feature", "value")
    long = P.to_long(sp.select("tx_id", *[F.coalesce(F.col(c), F.lit(fills[c])).alias(c) for c in cats]),
                     cats, ["tx_id"], "string")
    from txscore.operators.ordered import join_small
    hit = join_small(long, surv, ["feature", "value"])
    return hit.select("tx_id", F.concat(F.lit("cat__"), "feature", F.lit("_"), "value").alias("feature_value"))


register("onehot_long", "AGG-4,R3", with_ctes(
    *BASE, NULLRATE_SQL, FILL_SQL, SHARES_SQL, """alll AS (
  SELECT tx_id, 'product' AS feature, coalesce(product, (SELECT fill_cat FROM fills WHERE feature = 'product')) AS value FROM split
  UNION ALL SELECT tx_id, 'card', coalesce(card, (SELECT fill_cat FROM fills WHERE feature = 'card')) FROM split
  UNION ALL SELECT tx_id, 'email', coalesce(email, (SELECT fill_cat FROM fills WHERE feature = 'email')) FROM split)""",
    body="SELECT a.tx_id, 'cat__' || a.feature || '_' || a.value AS feature_value "
         "FROM alll a JOIN shares s ON s.feature = a.feature AND s.value = a.value WHERE s.kept"))(onehot_long_df)


def variance_filter_df(spark, sf_dir):
    _, imp, cats, nums, fills, summary = _imputed_train(spark, sf_dir)
    rob = {r["feature"]: r for r in P.robust_table(imp, nums, summary=summary).collect()}
    scaled = imp.select(*[((F.col(c) - F.lit(float(rob[c]["center"]))) / F.lit(float(rob[c]["scale"]))).alias(c)
                          for c in nums])
    nv = P.numeric_variances(scaled, nums).select(F.concat(F.lit("num__"), "feature").alias("feature"),
                                                  "variance", "kept")
    cv = P.category_shares(imp, cats).select(
        F.concat(F.lit("cat__"), "feature", F.lit("_"), "value").alias("feature"), "variance", "kept")
    return cv.unionByName(nv).select("feature", r6("variance").alias("variance"), "kept")


register("variance_filter", "AGG-5", with_ctes(
    *BASE, NULLRATE_SQL, FILL_SQL, ROBUST_SQL, SHARES_SQL,
    body="SELECT 'cat__' || feature || '_' || value AS feature, " + S.r6("variance") + " AS variance, kept FROM shares "
    "UNION ALL SELECT 'num__' || feature, " + S.r6("v") + ", v > 0.05 FROM (UNPIVOT (SELECT "
    + ", ".join(f"var_pop({_scaled_sql(c)}) AS {c}" for c in _KEPT_NUMS)
    + " FROM train) ON " + ", ".join(_KEPT_NUMS) + " INTO NAME feature VALUE v)"))(variance_filter_df)


def fitted_preparation(spark, sf_dir):
    sp = split_tx(spark, sf_dir)
    train = sp.where(F.col("part") == "train").drop("part")
    return P.fit_preparation(sp.drop("part"), train, CATS, NUMS, k=TOP_K, string_cols=CATS)


def _mi_table(spark, sf_dir):
    model, tables = fitted_preparation(spark, sf_dir)
    return tables["mi"]


def mutual_information_df(spark, sf_dir):
    return _mi_table(spark, sf_dir).select("feature", "ordinal", r6("mi").alias("mi"), "mi_rank")


def select_top_k_df(spark, sf_dir):
    return _mi_table(spark, sf_dir).select("feature", "ordinal", r6("mi").alias("mi"), "selected")


_MI_SQL = ("""vstat AS (
  SELECT * FROM (UNPIVOT (SELECT """ + ", ".join(f"var_pop({_scaled_sql(c)}) AS {c}" for c in _KEPT_NUMS) + """
  FROM train) ON """ + ", ".join(_KEPT_NUMS) + """ INTO NAME feature VALUE v) WHERE v > 0.05),
dums AS (
  SELECT feature, value, 'cat__' || feature || '_' || value AS name,
         ROW_NUMBER() OVER (ORDER BY CASE feature WHEN 'product' THEN 0 WHEN 'card' THEN 1 ELSE 2 END, value) - 1 AS ordinal
  FROM shares WHERE kept),
impn AS (
  SELECT label, feature, coalesce(value, (SELECT fill_num FROM fills f WHERE f.feature = x.feature)) AS value
  FROM (""" + " UNION ALL ".join(f"SELECT label, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM train"
                                for c in _KEPT_NUMS) + """) x
  WHERE feature IN (SELECT feature FROM vstat)),
rng AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM impn GROUP BY feature),
nums AS (
  SELECT feature, 'num__' || feature AS name,
         (SELECT COUNT(*) FROM dums) + ROW_NUMBER() OVER (ORDER BY CASE feature """
+ " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(_KEPT_NUMS)) + """ END) - 1 AS ordinal
  FROM vstat),
cnts AS (
  SELECT d.name AS feature, CASE WHEN i.value = d.value THEN 1 ELSE 0 END AS x, i.label AS y, COUNT(*) AS n
  FROM impc_l i JOIN dums d ON d.feature = i.feature GROUP BY 1, 2, 3
  UNION ALL
  SELECT 'num__' || i.feature, CASE WHEN r.hi = r.lo THEN 0
         ELSE least(floor((i.value - r.lo) / (r.hi - r.lo) * 10.0::DOUBLE), 9) END, i.label, COUNT(*)
  FROM impn i JOIN rng r ON r.feature = i.feature GROUP BY 1, 2, 3),
mis AS (
  SELECT feature, SUM(CASE WHEN n > 0 THEN (CAST(n AS DOUBLE) / nt) * ln((CAST(n AS DOUBLE) * nt) / (CAST(nx AS DOUBLE) * ny)) ELSE 0 END) AS mi
  FROM (SELECT feature, x, y, n,
               SUM(n) OVER (PARTITION BY feature, x) AS nx, SUM(n) OVER (PARTITION BY feature, y) AS ny,
               SUM(n) OVER (PARTITION BY feature) AS nt FROM cnts)
  GROUP BY feature),
ords AS (SELECT name, ordinal FROM dums UNION ALL SELECT name, ordinal FROM nums),
ranked AS (
  SELECT m.feature, CAST(o.ordinal AS BIGINT) AS ordinal, m.mi,
         ROW_NUMBER() OVER (ORDER BY round(coalesce(m.mi, 0.0), 10) DESC, o.ordinal DESC) <= """ + str(TOP_K) + """ AS selected,
         ROW_NUMBER() OVER (ORDER BY round(coalesce(m.mi, 0.0), 10) ASC, o.ordinal ASC) AS mi_rank
  FROM mis m JOIN ords o ON o.name = m.feature)""")
_IMPC_L = """impc_l AS (
  SELECT label, 'product' AS feature, coalesce(product, (SELECT fill_cat FROM fills WHERE feature = 'product')) AS value FROM train
  UNION ALL SELECT label, 'card', coalesce(card, (SELECT fill_cat FROM fills WHERE feature = 'card')) FROM train
  UNION ALL SELECT label, 'email', coalesce(email, (SELECT fill_cat FROM fills WHERE feature = 'email')) FROM train)"""

@register("mutual_information_nearest", "AGG-6,PRJ-16,UDF-1,SRT-2")
def mutual_information_nearest_df(spark, sf_dir):
    """The preparation with features ranked by nearest-neighbour mutual information: dummies are
    discrete, numerics continuous."""
    from txscore.operators import information as I
    sp = split_tx(spark, sf_dir)
    train = sp.where(F.col("part") == "train").drop("part")
    _, tables = P.fit_preparation(sp.drop("part"), train, CATS, NUMS, k=TOP_K, string_cols=CATS,
                                  score_function=I.nearest)
    flag = I.discrete_flags([r.feature for r in tables["mi"].select("feature").collect()])  # one row a feature
    discrete = F.create_map(*[x for f, d in flag.items() for x in (F.lit(f), F.lit(d))])[F.col("feature")]
    return tables["mi"].select("feature", "ordinal", r6("mi").alias("mi"), discrete.alias("is_discrete"), "selected")


register("mutual_information", "AGG-6,SRT-2,PRJ-14", with_ctes(
    *BASE, NULLRATE_SQL, FILL_SQL, ROBUST_SQL, SHARES_SQL, _IMPC_L, _MI_SQL,
    body=f"SELECT feature, ordinal, {S.r6('mi')} AS mi, mi_rank FROM ranked"))(mutual_information_df)
register("select_top_k", "SRT-1,PRJ-14", with_ctes(
    *BASE, NULLRATE_SQL, FILL_SQL, ROBUST_SQL, SHARES_SQL, _IMPC_L, _MI_SQL,
    body=f"SELECT feature, ordinal, {S.r6('mi')} AS mi, selected FROM ranked"))(select_top_k_df)


def capped_sample_df(spark, sf_dir):
    return SM.capped_sample(tx_view(spark, sf_dir)).select("tx_id", "label")


register("capped_sample", "SMP-4,SET-1,PRJ-10", with_ctes(
    TX_SQL, body=f"""SELECT tx_id, label FROM (
  SELECT tx_id, label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_H}, tx_id) AS rn,
         least(SUM(label) OVER (), 17) AS take_pos FROM tx)
WHERE (label = 1 AND rn <= take_pos) OR (label <> 1 AND rn <= greatest(0, 100 - take_pos))"""))(capped_sample_df)


def background_sample_df(spark, sf_dir):
    return SM.background_sample(tx_view(spark, sf_dir)).select("tx_id", "label")


register("background_sample", "SMP-5", with_ctes(
    TX_SQL, body=f"SELECT tx_id, label FROM tx ORDER BY {_H}, tx_id LIMIT 50"))(background_sample_df)
