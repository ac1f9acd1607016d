"""Readers for the driver tables and the derived transaction view.

``tx`` is a deterministic transaction table derived from ``events``: one row
per event with an integer second offset, an amount, two categorical codes, a
JSON-extracted numeric, two nullable numerics and a nullable text field, plus a
rare positive label. ``TX_SQL`` is the same view written for an ANSI engine, so
every catalogue query can be checked against an independent SQL run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Origin of the integer time axis (seconds); the raw axis has no calendar meaning.
EPOCH_NTZ = "2024-01-01 00:00:00"

NUMERIC_FEATURES = ["amt", "k", "d1", "v_sparse"]
CATEGORICAL_FEATURES = ["product", "card", "email"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tx_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx_from_events(read_table(spark, sf_dir, "events"))


def tx_from_events(ev: DataFrame) -> DataFrame:
    """The transaction projection of an events frame (batch or streaming)."""
    eid = F.col("event_id")
    return ev.select(
        eid.alias("tx_id"),
        F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'{EPOCH_NTZ}', ts)").alias("dt"),
        F.col("value").alias("amt"),
        F.col("event_type").alias("product"),
        F.col("user_id").cast("string").alias("card"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.when(eid % 4 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") / (F.lit(1) + eid % 7)).alias("d1"),
        F.when(eid % 20 == 0, F.col("value")).alias("v_sparse"),
        F.when(eid % 11 == 0, F.lit(None).cast("string"))
         .when(eid % 13 == 0, F.lit("  "))
         .otherwise(F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string"))).alias("email"),
        F.when(((F.col("value") > 150) & F.col("event_type").isin("error", "purchase"))
               | (eid % 97 == 0), 1).otherwise(0).alias("label"),
    )


TX_SQL = f"""tx AS (
  SELECT event_id AS tx_id,
         date_diff('second', TIMESTAMP '{EPOCH_NTZ}', ts) AS dt,
         value AS amt,
         event_type AS product,
         CAST(user_id AS VARCHAR) AS card,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / (1 + event_id % 7) END AS d1,
         CASE WHEN event_id % 20 = 0 THEN value END AS v_sparse,
         CASE WHEN event_id % 11 = 0 THEN NULL
              WHEN event_id % 13 = 0 THEN '  '
              ELSE 'm' || CAST(user_id % 5 AS VARCHAR) END AS email,
         CASE WHEN (value > 150 AND event_type IN ('error', 'purchase'))
                   OR event_id % 97 = 0 THEN 1 ELSE 0 END AS label
  FROM events)"""


# --- score table -----------------------------------------------------------
# Four rule scorers over tx whose outputs are exact IEEE results of the same
# operations in any engine (division, multiplication, floor), with many ties.

def _score_exprs() -> dict[str, Column]:
    amt = F.col("amt")
    k = F.col("k").cast("double")
    d1 = F.coalesce(F.col("d1"), F.lit(0.0))
    ratio = amt / (amt + F.lit(50.0))
    return {
        "amount": F.floor(F.lit(1000.0) * ratio) / F.lit(1000.0),
        "k": k / F.lit(100.0),
        "blend": F.floor(F.lit(1000.0) * (F.lit(0.5) * ratio + F.lit(0.005) * k)) / F.lit(1000.0),
        "d1": F.floor(F.lit(100.0) * (d1 / (d1 + F.lit(25.0)))) / F.lit(100.0),
    }


SCORE_MODELS = ["amount", "k", "blend", "d1"]


def score_table(tx: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long score table (tx_id, model, label, score, pred, keep…) in one pass over tx."""
    structs = [F.struct(F.lit(m).alias("model"), e.cast("double").alias("score"))
               for m, e in _score_exprs().items()]
    return (tx.select("tx_id", "label", *keep, F.explode(F.array(*structs)).alias("s"))
              .select("tx_id", F.col("s.model").alias("model"), "label",
                      F.col("s.score").alias("score"), *keep)
              .withColumn("pred", (F.col("score") >= 0.5).cast("int")))


SCORES_SQL = """scores AS (
  SELECT tx_id, model, label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM (
    SELECT tx_id, label, 'amount' AS model,
           floor(1000.0::DOUBLE * (amt / (amt + 50.0::DOUBLE))) / 1000.0::DOUBLE AS score FROM tx
    UNION ALL
    SELECT tx_id, label, 'k', CAST(k AS DOUBLE) / 100.0::DOUBLE FROM tx
    UNION ALL
    SELECT tx_id, label, 'blend',
           floor(1000.0::DOUBLE * (0.5::DOUBLE * (amt / (amt + 50.0::DOUBLE))
                 + 0.005::DOUBLE * CAST(k AS DOUBLE))) / 1000.0::DOUBLE FROM tx
    UNION ALL
    SELECT tx_id, label, 'd1',
           floor(100.0::DOUBLE * (coalesce(d1, 0.0::DOUBLE) / (coalesce(d1, 0.0::DOUBLE) + 25.0::DOUBLE)))
             / 100.0::DOUBLE FROM tx))"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
