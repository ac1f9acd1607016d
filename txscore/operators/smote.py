"""SMOTE oversampling as DataFrame operations.

Minority rows get their k nearest minority neighbours from the exact band join
(``neighbors.knn_join``, self excluded). The number of synthetic rows is
floor(ratio * n_majority - n_minority); synthetic row s (0-based) starts from
the minority row of hash rank (s mod n_min) + 1, so every minority row seeds
floor(n_new / n_min) or one more rows. Its neighbour slot and its gap
u in [0, 1) are drawn from the portable hash of (base id, s); the new vector
is x + u * (neighbour - x). Originals and synthetic rows are returned as one
union with an ``is_synthetic`` flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.functions.hashing import DEFAULT_SEED, row_hash, uniform
from txscore.operators.neighbors import knn_join
from txscore.operators.ordered import ordered_row_number

# Fixed value of the source pipeline: neighbours of a minority row.
SMOTE_K = 5


def synthetic_count(n_majority: int, n_minority: int, ratio: float) -> int:
    return max(0, int(ratio * n_majority - n_minority))


def smote(df: DataFrame, id_col: str = "id", vec_col: str = "vec", label: str = "label",
          ratio: float = 0.20, k: int = SMOTE_K, metric: str = "l2", seed: int = DEFAULT_SEED,
          minority_label: int = 1, group: str | None = None) -> DataFrame:
    """Balanced table (group?, id, label, vec, is_synthetic, base_id, neighbor_id, gap).

    Synthetic ids are negative: -(s + 1). With ``group`` (an integer column) every
    group is oversampled on its own -- e.g. the training part of every fold -- in
    the same jobs; the per-group counts are one small collected table.
    """
    gk = [group] if group else []
    base = df.select(*gk, F.col(id_col).alias("id"), F.col(label).alias("label"),
                     F.col(vec_col).cast("array<double>").alias("vec"))
    counts: dict = {}
    for r in base.groupBy(*gk, "label").agg(F.count(F.lit(1)).alias("n")).collect():   # groups x classes
        g = r[group] if group else 0
        c = counts.setdefault(g, [0, 0])
        c[0 if r["label"] == minority_label else 1] += r["n"]
    plan = {g: (n_min, synthetic_count(n_maj, n_min, ratio)) for g, (n_min, n_maj) in counts.items()}
    originals = base.select(*gk, "id", "label", "vec", F.lit(False).alias("is_synthetic"),
                            F.lit(None).cast("long").alias("base_id"),
                            F.lit(None).cast("long").alias("neighbor_id"),
                            F.lit(None).cast("double").alias("gap"))
    active = {g: v for g, v in plan.items() if v[1] > 0}
    if not active:
        return originals
    few = sorted(g for g, v in active.items() if v[0] < 2)
    if few:
        raise ValueError(f"groups {few} need synthetic rows but have fewer than two minority rows" if group
                         else "fewer than two minority rows: nothing to interpolate")
    # every group uses its own number of neighbours: k, or all others if it has fewer
    slots = {g: min(k, v[0] - 1) for g, v in active.items()}
    minority = base.where(F.col("label") == minority_label)
    nbrs = knn_join(minority, minority, max(slots.values()), q_id="id", r_id="id", q_vec="vec", r_vec="vec",
                    metric=metric, exclude_self=True, group=group)
    ranked = ordered_row_number(minority.withColumn("_h", row_hash("id", seed)), gk,
                                [F.col("_h"), F.col("id")], "_i")

    def lookup(values: dict) -> Column:
        if not group:
            return F.lit(list(values.values())[0])
        m = F.create_map(*[x for g, v in values.items() for x in (F.lit(g), F.lit(v))])
        return F.coalesce(m[F.col(group)], F.lit(0))

    n_min_c = lookup({g: v[0] for g, v in active.items()})
    per_c = lookup({g: v[1] // v[0] for g, v in active.items()})
    slots_c = F.greatest(lookup(slots), F.lit(1))
    extra_c = lookup({g: v[1] % v[0] for g, v in active.items()})
    copies = per_c + F.when(F.col("_i") <= extra_c, 1).otherwise(0)
    seeds = (ranked.where(copies > 0)
             .select(*gk, "id", "vec", "_i", F.explode(F.sequence(F.lit(0), copies - 1)).alias("_c"))
             .withColumn("s", F.col("_c") * n_min_c + F.col("_i") - 1))
    h = row_hash("id", seed, "s")
    seeds = (seeds.withColumn("slot", (F.conv(F.substring(h, 9, 8), 16, 10).cast("long") % slots_c) + 1)
                  .withColumn("gap", uniform(h)))
    picked = seeds.join(nbrs.select(*gk, F.col("q_id").alias("id"), F.col("rank").alias("slot"),
                                    F.col("r_id").alias("neighbor_id")), gk + ["id", "slot"])
    nvec = minority.select(*gk, F.col("id").alias("neighbor_id"), F.col("vec").alias("_nvec"))
    synth = picked.join(nvec, gk + ["neighbor_id"]).select(
        *gk, (-(F.col("s") + 1)).cast("long").alias("id"), F.lit(minority_label).alias("label"),
        F.zip_with("vec", "_nvec", lambda x, y: x + F.col("gap") * (y - x)).alias("vec"),
        F.lit(True).alias("is_synthetic"), F.col("id").alias("base_id"), "neighbor_id", "gap")
    return originals.unionByName(synth)
