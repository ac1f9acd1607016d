"""Ordered running sums and row numbers without a one-task window.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task; a
group that holds a third of the table (the majority class, one model's scores)
would then sit in a single task. ``ordered_prefix`` instead

1. range-partitions the rows on (group, order) -- the sampler balances the
   parts even when one group dominates -- and records the part id,
2. freezes that assignment with a reliable ``checkpoint`` (shared
   ``spark.checkpoint.dir``; survives executor loss and makes the part ids
   deterministic for the two reads below),
3. computes running sums inside each (part, group) slice,
4. adds the totals of all earlier parts of the same group, taken from a tiny
   per-(part, group) table.

The offset table has one row per (part, group) slice. It is joined on its typed
keys (null-safe), broadcast only after a check of its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from txscore.session import ensure_checkpoint_dir, shuffle_partitions

# Largest table (bytes, as estimated from its counted rows) that is broadcast.
BROADCAST_MAX_BYTES = 16 << 20
# Bytes assumed for a text cell in that estimate.
TEXT_BYTES = 64


def row_bytes(schema: StructType) -> int:
    """Estimated size of a row: fixed-size fields count 16 bytes, text more."""
    return sum(TEXT_BYTES if isinstance(f.dataType, StringType) else 16 for f in schema)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join, broadcasting ``small`` only if its counted rows are within bound.

    ``small`` is cut from its lineage first, so that the count and the join read
    it once computed."""
    ensure_checkpoint_dir(big.sparkSession)
    small = small.checkpoint(eager=True)
    if small.count() * row_bytes(small.schema) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def ordered_prefix(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                   sum_cols: Sequence[str] = (), index_col: str = "idx",
                   num_parts: int | None = None) -> DataFrame:
    """Append inclusive running sums ``cum_<c>`` and a 1-based ``index_col``.

    The order (``order`` after ``group_cols``) must be unique within a group,
    otherwise tied rows get an arbitrary relative order.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = num_parts or shuffle_partitions(spark)
    group_cols = list(group_cols)
    keys = [F.col(g) for g in group_cols] + list(order)

    ranged = (df.repartitionByRange(parts, *keys)
                .withColumn("_part", F.spark_partition_id())
                .checkpoint(eager=True))

    slice_cols = ["_part"] + group_cols
    w = (Window.partitionBy(*slice_cols).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select(
        "*",
        *[F.sum(c).over(w).alias(f"_loc_{c}") for c in sum_cols],
        F.count(F.lit(1)).over(w).alias("_loc_n"))

    totals = ranged.groupBy(*slice_cols).agg(
        *[F.sum(c).alias(f"_tot_{c}") for c in sum_cols],
        F.count(F.lit(1)).alias("_tot_n"))
    before = (Window.partitionBy(*group_cols).orderBy("_part")
              .rowsBetween(Window.unboundedPreceding, -1))
    keys = [F.col(c).alias(f"_key{i}") for i, c in enumerate(slice_cols)]
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
          for c in sum_cols],
        F.coalesce(F.sum("_tot_n").over(before), F.lit(0)).alias("_off_n"))
    match = F.lit(True)
    for i, c in enumerate(slice_cols):
        match = match & F.col(c).eqNullSafe(F.col(f"_key{i}"))
    joined = join_small(local, offsets, match)
    return joined.select(
        *df.columns,
        *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
        (F.col("_loc_n") + F.col("_off_n")).cast("long").alias(index_col))


def ordered_row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                       index_col: str = "rn") -> DataFrame:
    """Distributed ``row_number() over (partition by group order by order)``."""
    return ordered_prefix(df, group_cols, order, (), index_col=index_col)


# Ranks of equal values that one row stands for before they are dealt out to tasks.
TIE_CHUNK = 1 << 16


def value_ranks(df: DataFrame, group_cols: Sequence[str], value: str, index_col: str = "rn") -> DataFrame:
    """(group…, value, rank): the ranks of all rows in value order, one row each.

    Only distinct values with their counts are ordered, so that a value which most rows
    share is one row of the range partitioning; its ranks are dealt out in chunks."""
    g = list(group_cols)
    per = df.groupBy(*g, value).agg(F.count(F.lit(1)).alias("_c"))
    cum = ordered_prefix(per, g, [F.col(value).asc()], ["_c"], index_col="_i")
    chunks = cum.select(*g, value, F.col("cum__c").alias("_last"), F.explode(F.sequence(
        F.col("cum__c") - F.col("_c") + 1, F.col("cum__c"), F.lit(TIE_CHUNK).cast("long"))).alias("_first"))
    ends = F.least(F.col("_first") + F.lit(TIE_CHUNK - 1), F.col("_last"))
    return (chunks.repartition(shuffle_partitions(df.sparkSession))
            .select(*g, value, F.explode(F.sequence("_first", ends)).alias(index_col)))
