"""Seeded splitting, fold assignment and sampling without ``rand()``.

All choices order rows by the portable md5 hash of (id, seed); ranks inside a
label come from ``ordered_row_number`` (range partitioned), so the majority
class never sits in one task. Rates are applied per class, so every class keeps
its share (stratification).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.functions.hashing import DEFAULT_SEED, row_hash
from txscore.operators.ordered import ordered_row_number


def _ranked(df: DataFrame, id_col: str, label: str, seed: int, salt=()) -> DataFrame:
    h = df.withColumn("_h", row_hash(id_col, seed, *salt))
    return ordered_row_number(h, [label], [F.col("_h"), F.col(id_col)], "_rn")


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class (the imbalance profile)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


# rows fetched to the driver once a refined hash bucket is this small
CUTOFF_COLLECT_MAX = 10_000
HEX_STEP = 4                  # hex digits added per refinement pass (65,536 buckets)


def kth_by_hash(df: DataFrame, h_col: str, id_col: str, label: str, ks: dict) -> dict:
    """Exact k-th smallest (hash, id) per class without sorting the table.

    Each pass counts rows per (class, next ``HEX_STEP`` hex digits of the hash)
    inside the bucket found so far -- a grouped count over a narrow projection,
    at most 65,536 buckets per class to the driver -- until the bucket holding
    rank k is small enough to fetch and sort. A few passes resolve any size.
    """
    todo = {lab: ("", k) for lab, k in ks.items() if k > 0}
    done: dict = {}
    while todo:
        depth = {lab: len(pref) for lab, (pref, _) in todo.items()}
        cond = None
        for lab, (pref, _) in todo.items():
            c = (F.col(label) == F.lit(lab)) & F.col(h_col).startswith(pref)
            cond = c if cond is None else cond | c
        step = df.where(cond)
        plen = F.coalesce(F.create_map(*[x for lab, d in depth.items() for x in (F.lit(lab), F.lit(d))])
                          [F.col(label)], F.lit(0))
        counts = (step.select(label, F.col(h_col).alias("_h"), plen.alias("_d"))
                  .select(label, F.expr(f"substring(_h, 1, _d + {HEX_STEP})").alias("_b"))
                  .groupBy(label, "_b").agg(F.count(F.lit(1)).alias("n")).collect())
        per: dict = {}
        for r in counts:
            per.setdefault(r[label], []).append((r["_b"], r["n"]))
        nxt = {}
        for lab, (pref, k) in todo.items():
            seen = 0
            for b, n in sorted(per.get(lab, [])):
                if seen + n >= k:
                    if n <= CUTOFF_COLLECT_MAX or len(b) >= 32:
                        rows = (df.where((F.col(label) == F.lit(lab)) & F.col(h_col).startswith(b))
                                  .select(h_col, id_col).collect())
                        rows.sort(key=lambda r: (r[h_col], r[id_col]))
                        hit = rows[k - seen - 1]
                        done[lab] = (hit[h_col], hit[id_col])
                    else:
                        nxt[lab] = (b, k - seen)
                    break
                seen += n
        todo = nxt
    return done


def stratified_split(df: DataFrame, test_size: float = 0.25, id_col: str = "tx_id",
                     label: str = "label", seed: int = DEFAULT_SEED) -> DataFrame:
    """Add ``part`` in {'train', 'test'}: the first round(test_size * n_class)
    rows of each class in (hash, id) order go to test. Rows without a label belong to
    neither part (``part`` is NULL).

    The per-class cut-off row is found by prefix-histogram refinement
    (``kth_by_hash``), so the split is a filter on a literal cut-off: no sort,
    no shuffle or rewrite of the table."""
    h = df.withColumn("_h", row_hash(id_col, seed))
    # one row per class (a label column): the cut-offs become literals
    ks = {r[label]: int(math.floor(test_size * r["n"] + 0.5)) for r in class_counts(df, label).where(F.col(label).isNotNull()).collect()}
    cut = kth_by_hash(h, "_h", id_col, label, ks)
    is_test = F.lit(False)
    for lab, (ch, cid) in cut.items():
        inside = (F.col("_h") < F.lit(ch)) | ((F.col("_h") == F.lit(ch)) & (F.col(id_col) <= F.lit(cid)))
        is_test = is_test | ((F.col(label) == F.lit(lab)) & inside)
    return h.withColumn("part", F.when(is_test, "test").when(F.col(label).isNotNull(), "train")).drop("_h")


def stratified_folds(df: DataFrame, n_folds: int = 10, id_col: str = "tx_id",
                     label: str = "label", seed: int = DEFAULT_SEED) -> DataFrame:
    """Add ``fold`` = (rank within class in hash order - 1) mod n_folds; fold
    sizes differ by at most one per class."""
    ranked = _ranked(df, id_col, label, seed)
    return ranked.withColumn("fold", ((F.col("_rn") - 1) % n_folds).cast("int")).drop("_h", "_rn")


def capped_sample(df: DataFrame, max_samples: int = 100, min_minority: int = 17,
                  id_col: str = "tx_id", label: str = "label",
                  seed: int = DEFAULT_SEED) -> DataFrame:
    """At most ``min_minority`` positives (the value acts as a cap), the rest of
    ``max_samples`` from negatives (never below 0); rows in seeded-shuffle order.

    The limit is the feature here (an explanation sample of fixed budget).
    """
    n_pos = df.where(F.col(label) == 1).count()  # one scalar to the driver
    take_pos = min(n_pos, min_minority)
    take_neg = max(0, max_samples - take_pos)
    h = df.withColumn("_h", row_hash(id_col, seed))
    # distributed top-n per class (each task keeps n, then one merge of n rows)
    pos = h.where(F.col(label) == 1).orderBy("_h", id_col).limit(take_pos)
    neg = h.where(F.col(label) != 1).orderBy("_h", id_col).limit(take_neg)
    return pos.unionByName(neg).drop("_h")


def background_sample(df: DataFrame, n: int = 50, id_col: str = "tx_id",
                      seed: int = DEFAULT_SEED) -> DataFrame:
    """``n`` rows uniformly by seeded hash order (top-n, a bounded sample)."""
    return (df.withColumn("_h", row_hash(id_col, seed))
              .orderBy("_h", id_col).limit(n).drop("_h"))
