"""Majority vote of several models' predictions per transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERDICT_POSITIVE = "Fraudulent"
VERDICT_NEGATIVE = "Legitimate"


def verdict(pred: Column) -> Column:
    return F.when(pred == 1, F.lit(VERDICT_POSITIVE)).otherwise(F.lit(VERDICT_NEGATIVE))


def majority_vote(preds: DataFrame, id_col: str = "tx_id", pred: str = "pred") -> DataFrame:
    """Long input (id, model, pred): fraud iff fraud votes > legit votes (a tie
    is Legitimate). One shuffle on the id with map-side partial counts."""
    g = preds.groupBy(id_col).agg(F.sum(F.col(pred).cast("long")).alias("fraud_votes"),
                                  F.count(F.lit(1)).alias("_n"))
    return g.select(id_col, "fraud_votes", (F.col("_n") - F.col("fraud_votes")).alias("legit_votes"),
                    verdict((F.col("fraud_votes") > F.col("_n") - F.col("fraud_votes")).cast("int"))
                    .alias("verdict"))


def vote_columns(preds: Sequence[Column]) -> dict[str, Column]:
    """Row-wise vote over prediction columns of one wide row (no shuffle)."""
    fraud = sum((p.cast("long") for p in preds), F.lit(0).cast("long"))
    legit = F.lit(len(preds)).cast("long") - fraud
    return {"fraud_votes": fraud, "legit_votes": legit,
            "verdict": verdict((fraud > legit).cast("int"))}
