"""Streaming and I/O queries: frozen preparation and vote on an event stream
(drained with ``availableNow``), CSV ingest of delimited records, and the
metric log round trip (append sink, JSON cells decoded on read)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.functions.algebra import r6
from txscore.operators import metrics as M
from txscore.operators import prep as P
from txscore.operators.vote import majority_vote
from txscore.plans import preparation as PP
from txscore.plans import sqlkit as S
from txscore.plans.registry import CATALOG, register
from txscore.sources import io as IO
from txscore.sources.tables import SCORES_SQL, TX_SQL, score_table, tx_from_events, tx_view, with_ctes
from txscore.streaming import scoring as ST


def stream_prepare_df(spark, sf_dir):
    model, _ = PP.fitted_preparation(spark, sf_dir)
    path = IO.shared_path(spark, "prepared_model")
    model.save(spark, path)                       # fitted state persisted ...
    frozen = P.PreparedModel.load(spark, path)    # ... and reloaded by the scoring job
    out = ST.run_available_now(ST.prepare_stream(ST.events_stream(spark, sf_dir), frozen), spark, "prepare")
    return out.select("tx_id", "feature", r6("value").alias("value"))


_num_long_all = " UNION ALL ".join(
    f"SELECT tx_id, 'num__{c}' AS feature, {PP._scaled_sql(c)} AS value FROM split" for c in PP._KEPT_NUMS)
register("stream_prepare", "STR-1,PRJ-11,SNK-5,SRC-4", with_ctes(
    *PP.BASE, PP.NULLRATE_SQL, PP.FILL_SQL, PP.ROBUST_SQL, PP.SHARES_SQL, PP._IMPC_L, PP._MI_SQL,
    """alll AS (
  SELECT tx_id, 'product' AS feature, coalesce(product, (SELECT fill_cat FROM fills WHERE feature = 'product')) AS value FROM split
  UNION ALL SELECT tx_id, 'card', coalesce(card, (SELECT fill_cat FROM fills WHERE feature = 'card')) FROM split
  UNION ALL SELECT tx_id, 'email', coalesce(email, (SELECT fill_cat FROM fills WHERE feature = 'email')) FROM split)""",
    f"""pl AS (
  SELECT a.tx_id, d.name AS feature, CASE WHEN a.value = d.value THEN 1.0 ELSE 0.0 END AS value
  FROM alll a JOIN dums d ON d.feature = a.feature
  UNION ALL {_num_long_all})""",
    body=f"SELECT tx_id, feature, {S.r6('value')} AS value FROM pl "
         "WHERE feature IN (SELECT feature FROM ranked WHERE selected)"))(stream_prepare_df)


def stream_vote_df(spark, sf_dir):
    return ST.run_available_now(ST.vote_stream(ST.events_stream(spark, sf_dir)), spark, "vote")


register("stream_vote", "STR-2,AGG-11,PRJ-12", CATALOG["majority_vote"].sql)(stream_vote_df)


CSV_SCHEMA = "tx_id string, product string, card string, email string, amt string, k string, _corrupt string"


def stream_csv_ingest_df(spark, sf_dir):
    tx = tx_view(spark, sf_dir)
    text = tx.select(
        F.col("tx_id").cast("string").alias("tx_id"), "product",
        F.when(F.col("tx_id") % 2 == 0, F.concat(F.col("card"), F.lit(".0"))).otherwise(F.col("card")).alias("card"),
        "email", F.col("amt").cast("string").alias("amt"), F.col("k").cast("string").alias("k"))
    path = IO.shared_path(spark, "csv_in")
    IO.write_table(text, path, fmt="csv")
    stream = (spark.readStream.schema(CSV_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    clean = stream.select(
        F.col("tx_id").try_cast("bigint").alias("tx_id"),
        P.blank_to_null(F.col("product")).alias("product"),
        P.canonical_code(P.blank_to_null(F.col("card"))).alias("card"),
        P.canonical_code(P.blank_to_null(F.col("email"))).alias("email"),
        P.soft_double(F.col("amt")).alias("amt"), P.soft_double(F.col("k")).alias("k"),
        P.soft_double(F.col("email")).alias("email_num"))
    return ST.run_available_now(clean, spark, "csv")


register("stream_csv_ingest", "STR-4,SRC-1,SNK-1,PRJ-7,PRJ-8", CATALOG["blank_to_null_cast"].sql)(
    stream_csv_ingest_df)


RAW_SCHEMA = "tx_id bigint, product string, card string, amt double, k double, _corrupt string"


def raw_text(spark, sf_dir) -> DataFrame:
    """Lines of a delimited file as senders write them: quoted cells, blanks, NaN, codes in two
    spellings, and every 50th record cut short or with a word for a number."""
    tx = tx_view(spark, sf_dir)
    i = F.col("tx_id")
    card = F.when(i % 3 == 0, F.concat(F.col("card"), F.lit(".0"))).when(i % 7 == 0, F.lit(" ")).otherwise(F.col("card"))
    product = F.concat(F.lit('"'), "product", F.lit(', "" kind"'))
    k = F.when(i % 6 == 0, F.lit("NaN")).when(i % 10 == 0, F.lit("")).otherwise(F.col("k").cast("string"))
    whole = F.concat_ws(",", i.cast("string"), product, card, F.col("amt").cast("string"), k)
    return tx.select(F.when(i % 100 == 50, F.concat_ws(",", i.cast("string"), product))
                     .when(i % 100 == 0, F.concat_ws(",", i.cast("string"), product, card, F.lit("much"), k))
                     .otherwise(whole).alias("value"))


def stream_raw_ingest_df(spark, sf_dir):
    """Raw text in several files, read as a stream of several micro-batches: malformed records
    are told apart, kept cells and categories have one form."""
    path = IO.shared_path(spark, "raw_in")
    raw_text(spark, sf_dir).repartition(4).write.text(path)
    stream = (spark.readStream.schema(RAW_SCHEMA).option("mode", "PERMISSIVE")
              .option("maxFilesPerTrigger", 1).option("escape", '"')
              .option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    clean = P.clean(stream, ["product", "card"], ["amt", "k"])
    rows = clean.select("tx_id", "product", "card", "amt", "k", F.col("_corrupt").isNotNull().alias("malformed"))
    return ST.run_available_now(rows, spark, "raw")


register("stream_raw_ingest", "STR-4,SRC-1,PRJ-7,PRJ-8", with_ctes(
    TX_SQL, body="""SELECT tx_id, product || ', " kind' AS product,
       CASE WHEN tx_id % 100 = 50 OR (tx_id % 3 <> 0 AND tx_id % 7 = 0) THEN NULL ELSE card END AS card,
       CASE WHEN tx_id % 50 = 0 THEN NULL ELSE amt END AS amt,
       CASE WHEN tx_id % 100 = 50 OR tx_id % 6 = 0 OR tx_id % 10 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS k,
       tx_id % 50 = 0 AS malformed FROM tx"""))(stream_raw_ingest_df)


def stream_model_vote_df(spark, sf_dir):
    """Votes of the six fitted models on an event stream: each micro-batch goes through the
    frozen preparation, is scored by the loaded models, and the majority decides."""
    from txscore.plans import learning as L
    score = L.batch_scorer(spark, sf_dir)
    events = ST.events_stream(spark, sf_dir)
    return ST.run_available_now(tx_from_events(events), spark, "model_vote",
                                per_batch=lambda batch: majority_vote(score(batch)))


register("stream_model_vote", "STR-1,STR-2,AGG-11")(stream_model_vote_df)


def metrics_log_roundtrip_df(spark, sf_dir):
    rep = M.metrics_report(score_table(tx_view(spark, sf_dir)))
    path = IO.shared_path(spark, "metrics_log")
    IO.append_run(rep.withColumn("best_parameters", F.lit(IO.params_json({"rule": "score >= 0.5"}))),
                  path, "run-1")
    back = spark.read.parquet(path).where(F.col("run_id") == "run-1")
    m = IO.decode_matrix("confusion_matrix")
    dec = back.select("model", m[0][0].alias("tn"), m[0][1].alias("fp"), m[1][0].alias("fn"), m[1][1].alias("tp"))
    acc = M.rate_columns(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))["accuracy"]
    return dec.select("model", "tn", "fp", "fn", "tp", r6(acc).alias("accuracy"))


register("metrics_log_roundtrip", "SNK-2,SNK-4,SRC-3", with_ctes(
    TX_SQL, SCORES_SQL, """conf AS (
  SELECT model,
         CAST(SUM(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(SUM(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(SUM(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(SUM(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM scores GROUP BY model)""",
    body=f"SELECT model, tn, fp, fn, tp, {S.r6(S.ratio('tn + tp', 'tn + fp + fn + tp'))} AS accuracy FROM conf"))(
    metrics_log_roundtrip_df)


# ---- on-demand explanation of flagged records -----------------------------------

MAX_EVALS = 200      # fixed value: evaluation budget per explained record
TOP_SHOWN = 14       # fixed value: features shown per explained record


def stream_explain_df(spark, sf_dir):
    """Vote on the stream; for every micro-batch explain the records voted Fraudulent, whose
    features the stream carries, against a background sample taken once from the batch
    table: all coalitions of the three features, within the budget; the top features."""
    from pyspark.sql import Window
    from txscore.operators import explain as X
    from txscore.operators import sampling as SM
    from txscore.plans.explaining import EXPLAIN_FEATURES, smooth_score
    background = X.background_matrix(SM.background_sample(tx_view(spark, sf_dir)), EXPLAIN_FEATURES)
    votes = ST.vote_stream(ST.events_stream(spark, sf_dir), keep=EXPLAIN_FEATURES)
    flagged = votes.where(F.col("verdict") == "Fraudulent").select("tx_id", *EXPLAIN_FEATURES)

    def explain(batch):
        phi = X.shapley_exact(batch, background, EXPLAIN_FEATURES, smooth_score)
        w = Window.partitionBy("tx_id").orderBy(F.abs("phi").desc(), "feature")  # d rows per record
        return phi.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP_SHOWN)

    out = ST.run_available_now(flagged, spark, "explain", per_batch=explain)
    return out.select("tx_id", "feature", r6("phi", 9).alias("phi"), F.col("rank").cast("long").alias("rank"))


def _stream_explain_sql():
    from txscore.plans.explaining import _SHAP_SQL_CTES
    return with_ctes(*_SHAP_SQL_CTES, SCORES_SQL, """fl AS (
  SELECT tx_id FROM scores GROUP BY tx_id HAVING SUM(pred) > COUNT(*) - SUM(pred))""",
        body=f"""SELECT tx_id, feature, {S.r6('phi', 9)} AS phi,
       CAST(ROW_NUMBER() OVER (PARTITION BY tx_id ORDER BY abs(phi) DESC, feature) AS BIGINT) AS rank
FROM phi WHERE tx_id IN (SELECT tx_id FROM fl)""")


register("stream_explain", "STR-3,EXP-4,EXP-3", _stream_explain_sql())(stream_explain_df)


@register("stream_explain_boosted", "STR-3,EXP-4,STR-2")
def stream_explain_boosted_df(spark, sf_dir):
    """Arriving events through the frozen preparation and the fitted boosted trees; what these flag
    is explained in its micro-batch, each record once."""
    from txscore.operators import ensembles as E
    from txscore.operators import prep as P
    from txscore.operators import sampling as SM
    from txscore.operators.explain import background_matrix
    from txscore.plans import learning as L
    from txscore.plans import preparation as PP
    from txscore.session import materialize
    sp = PP.split_tx(spark, sf_dir)
    train = sp.where(F.col("part") == "train")
    frozen, _ = P.fit_preparation(sp, train, PP.CATS, PP.NUMS, string_cols=PP.CATS)
    feats = L.numbers(frozen.selected)
    ready = materialize(L.numbered(frozen.transform(train), frozen.selected, ("tx_id", "label")))
    model = E.load_models(E.fit_table(E.fit_sample(ready), feats, ["XGBoost"]))["XGBoost",]
    background = background_matrix(SM.background_sample(ready), feats)
    arriving = frozen.transform(tx_from_events(ST.events_stream(spark, sf_dir)), keep=("tx_id",))
    out = ST.explain_flagged(L.numbered(arriving, frozen.selected, ("tx_id",)), spark, "XGBoost", model, feats,
                             background, "explain_boosted", TOP_SHOWN)
    return out.select("tx_id", "feature", r6("phi").alias("phi"), "rank")


def stream_knn_scores_df(spark, sf_dir):
    """kNN scoring of arriving vectors: each micro-batch is joined (exact band
    kNN join) against the static training vectors inside ``foreachBatch``."""
    from txscore.operators.neighbors import knn_classify, knn_join
    from txscore.plans.modeling import KNN_K, embedding_split
    sp = embedding_split(spark, sf_dir)
    train = sp.where(F.col("part") == "train")
    test_ids = sp.where(F.col("part") == "test").select("id")
    stream = ST.table_stream(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))

    def score(batch):
        held = batch.join(test_ids, "id")            # vectors held out of training
        nn = knn_join(held, train, KNN_K, metric="l1")
        return knn_classify(nn, train, r_id="id").select(
            F.col("q_id").alias("vec_id"), r6("score").alias("score"), "pred")

    return ST.run_available_now(stream, spark, "knn", per_batch=score)


register("stream_knn_scores", "STR-2,MDL-1,JN-6", CATALOG["knn_scores"].sql)(stream_knn_scores_df)
