"""Exact k-nearest-neighbour join in blocks.

The references are cut into leaves by a k-d tree (medians of a bounded sample; every row is
assigned), and each leaf has its bounding box (smallest and largest value by dimension, of all its
rows). Then

1. *radius*: every query meets the references of its own leaf and that leaf's sibling; its k-th
   smallest distance there is an upper bound r(q) of its true k-th neighbour distance (no bound:
   everything),
2. *exact*: every query meets all leaves whose box is within r(q) of it, and the k best by
   (distance, id) are kept.

A row is at least as far away as the box that holds it, so the result is exact. How much the boxes
prune depends on the data: with few dimensions, or clustered or correlated ones, a query meets few
leaves; with many independent dimensions every box is near, and the join does the work of comparing
the query set with all references, in blocks (``candidate_share`` measures it). Either way no task
holds more than ``SLICE_ROWS`` references and ``SLICE_QUERIES`` queries: both sides of a leaf are cut
into slices, whatever their sizes. The distance blocks are computed with numpy inside a cogrouped
``applyInPandas`` (Arrow batches; coordinates summed left to right, the same order as the SQL form
``distance``), and only the best k per query leave it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.operators.ordered import join_small
from txscore.session import materialize, shuffle_partitions

TARGET_BAND_ROWS = 256   # reference rows per leaf, while there are fewer than BANDS leaves
BANDS = 4096             # leaves; larger tables have more rows in each
BOX_CELLS = 1 << 18      # dimensions of all boxes together
SAMPLE_ROWS = 1 << 15    # rows that set the cuts of the tree (about; all rows are assigned)
VISIT_CHUNK = 256        # queries that a task compares with all boxes at once
SLICE_ROWS = 1024        # references of a leaf in one task
SLICE_QUERIES = 8192     # queries of a leaf in one task


def distance(a: Column, b: Column, metric: str = "l1") -> Column:
    """L1 or L2 distance of two array<double> columns (left-to-right sum)."""
    if metric == "l1":
        parts = F.zip_with(a, b, lambda x, y: F.abs(x - y))
        return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    if metric == "l2":
        parts = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x))
    raise ValueError(metric)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of an Arrow column, none of them null; missing components are NaN."""
    flat = column.flatten()
    if len(flat) != len(column) * dim:
        raise ValueError(f"vectors must have {dim} components")
    return np.asarray(flat.to_numpy(zero_copy_only=False), float).reshape(-1, dim)


def _tree(refs: DataFrame, n_refs: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(axis, cut) of the inner nodes of a complete tree: node i has the children 2i + 1 and 2i + 2."""
    leaves = max(1, min(BANDS, n_refs // TARGET_BAND_ROWS, BOX_CELLS // dim))
    size = (1 << (leaves.bit_length() - 1)) - 1
    axis, cut = np.zeros(size, np.int64), np.full(size, math.inf)
    if not size:
        return axis, cut
    step = max(1, refs.count() // SAMPLE_ROWS)
    rows = refs.where(F.col("r_vec").isNotNull() & (F.pmod(F.xxhash64("_g", "r_id", "r_vec"), F.lit(step)) == 0)) \
        .limit(2 * SAMPLE_ROWS)
    x = np.array([r.r_vec for r in rows.select("r_vec").collect()], float).reshape(-1, dim)  # the bounded sample
    todo = [(0, x[np.isfinite(x).all(axis=1)])]
    while todo:
        i, own = todo.pop()
        if i >= size or len(own) < 2:
            continue
        a = int(own.var(axis=0).argmax())
        v = np.sort(own[:, a])
        if v[0] == v[-1]:
            continue
        m = v[(len(v) - 1) // 2]
        if m == v[-1]:
            m = v[np.searchsorted(v, m) - 1]
        axis[i], cut[i] = a, m
        left = own[:, a] <= m
        todo += [(2 * i + 1, own[left]), (2 * i + 2, own[~left])]
    return axis, cut


def _with_leaf(df: DataFrame, vec: str, dim: int, tree: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The rows with a ``leaf``; those without a vector are left out."""
    axis, cut = tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = _matrix(part.column(vec), dim)
            at = np.zeros(len(x), np.int64)
            for _ in range((len(axis) + 1).bit_length() - 1):
                at = 2 * at + 2 - (x[np.arange(len(x)), axis[at]] <= cut[at])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array((at - len(axis)).astype(np.int32))],
                                             [*part.schema.names, "leaf"])

    kinds = ", ".join(f"{c} {t}" for c, t in df.dtypes)
    return df.where(F.col(vec).isNotNull()).mapInArrow(run, f"{kinds}, leaf int")


def _boxes(refs: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaves, lowest, highest values) of the leaves that hold rows; components that aren't finite are
    at no finite distance and so belong to no box."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for part in batches:
            x, leaf = _matrix(part.column("r_vec"), dim), part.column("leaf").to_numpy()
            fine = np.isfinite(x).all(axis=1)
            x, leaf = x[fine], leaf[fine]
            order = np.argsort(leaf, kind="stable")
            x, (each, first) = x[order], np.unique(leaf[order], return_index=True)
            if not len(each):
                continue
            for g, lo, hi in zip(each.tolist(), np.minimum.reduceat(x, first), np.maximum.reduceat(x, first), strict=True):
                box = held.get(g)
                held[g] = [lo, hi] if box is None else [np.minimum(box[0], lo), np.maximum(box[1], hi)]
        for g, (lo, hi) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dim, g, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
                                              pa.array(lo), pa.array(hi)], ["leaf", "axis", "lo", "hi"])

    found = refs.select("r_vec", "leaf").mapInArrow(run, "leaf int, axis int, lo double, hi double") \
        .groupBy("leaf", "axis").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("leaf", "axis").toPandas()
    return (found["leaf"].to_numpy()[::dim], *(found[c].to_numpy().reshape(-1, dim) for c in ("lo", "hi")))  # BOX_CELLS


def _visits(queries: DataFrame, boxes: tuple[np.ndarray, np.ndarray, np.ndarray], dim: int, metric: str) -> DataFrame:
    """(_g, band, q_id, q_vec, _r): a row for each leaf whose box is within ``_r`` of a query."""
    sent = queries.sparkSession.sparkContext.broadcast(boxes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves, lo, hi = sent.value
        for part in batches:
            for start in range(0, part.num_rows, VISIT_CHUNK):
                own = part.slice(start, VISIT_CHUNK)
                x, r = _matrix(own.column("q_vec"), dim), own.column("_r").to_numpy()
                far = np.zeros((len(x), len(leaves)))
                for i in range(dim):
                    gap = np.maximum(lo[:, i] - x[:, i:i + 1], x[:, i:i + 1] - hi[:, i])
                    np.maximum(gap, 0, out=gap)
                    far += gap if metric == "l1" else gap * gap
                rows, at = np.nonzero((far if metric == "l1" else np.sqrt(far)) <= r[:, None])
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [own.column("_g").take(take), pa.array(leaves[at].astype(np.int32)),
                     *[own.column(c).take(take) for c in ("q_id", "q_vec", "_r")]], ["_g", "band", "q_id", "q_vec", "_r"])

    kind = dict(queries.dtypes)["q_id"]
    return queries.select("_g", "q_id", "q_vec", "_r").mapInArrow(
        run, f"_g long, band int, q_id {kind}, q_vec array<double>, _r double")


def block_topk(qk: DataFrame, rk: DataFrame, k: int, metric: str, exclude_self: bool) -> DataFrame:
    """Per band: the distances of its queries x references in numpy (Arrow batches),
    best k per query; candidates of one query from several tasks are merged afterwards.

    Both sides of a band are cut into slices by a hash of the id, and every pair of
    slices is a task. The slice counts are one row for each (group, band)."""
    fn = _block_topk_fn(k, metric, exclude_self)
    keys = ["_g", "band"]
    refs_n = rk.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / SLICE_ROWS).cast("int").alias("_rn"))
    asks_n = qk.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / SLICE_QUERIES).cast("int").alias("_qn"))
    slices = refs_n.join(asks_n, keys)
    rk, qk = join_small(rk, slices, keys), join_small(qk, slices, keys)
    rk = (rk.withColumn("_rs", F.pmod(F.xxhash64("r_id"), F.col("_rn")).cast("int"))
            .withColumn("_qs", F.explode(F.sequence(F.lit(0), F.col("_qn") - 1))).drop("_rn", "_qn"))
    qk = (qk.withColumn("_qs", F.pmod(F.xxhash64("q_id"), F.col("_qn")).cast("int"))
            .withColumn("_rs", F.explode(F.sequence(F.lit(0), F.col("_rn") - 1))).drop("_rn", "_qn"))
    task = [*keys, "_rs", "_qs"]
    # a fixed number of parts: the tables are small for their work, and adaptive execution would join them
    session = qk.sparkSession
    parts = max(shuffle_partitions(session), 4 * session.sparkContext.defaultParallelism)
    return (qk.repartition(parts, *task).groupBy(*task).cogroup(rk.repartition(parts, *task).groupBy(*task))
              .applyInPandas(fn, "_g long, q_id long, r_id long, dist double"))


def merge(cands: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each query, from all tasks."""
    w = Window.partitionBy("_g", "q_id").orderBy(F.col("dist"), F.col("r_id"))   # <= k per key and task
    return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn_join(queries: DataFrame, refs: DataFrame, k: int, q_id: str = "id", r_id: str = "id",
             q_vec: str = "vec", r_vec: str = "vec", metric: str = "l1",
             exclude_self: bool = False, group: str | None = None, share_only: bool = False):
    """(q_id, r_id, dist, rank) for the k nearest references of every query.

    Ties on distance are broken by reference id. ``exclude_self`` drops the pair
    with equal ids (self-join of one table). With ``group`` (an integer column on
    both sides) every group is an independent problem -- e.g. all cross-validation
    folds in one job -- and the group column is kept in the output.
    """
    dim = len(refs.where(F.col(r_vec).isNotNull()).select(r_vec).first()[0])
    gq = F.col(group).cast("long") if group else F.lit(0).cast("long")
    Q = queries.select(gq.alias("_g"), F.col(q_id).alias("q_id"), F.col(q_vec).cast("array<double>").alias("q_vec"))
    gr = F.col(group).cast("long") if group else F.lit(0).cast("long")
    R = refs.select(gr.alias("_g"), F.col(r_id).alias("r_id"), F.col(r_vec).cast("array<double>").alias("r_vec"))
    # a leaf of a group is what a task compares, so the largest group sets the number of leaves
    n_refs = R.groupBy("_g").count().agg(F.max("count")).first()[0] or 0
    tree = _tree(R, n_refs, dim)
    Rb = materialize(_with_leaf(R, "r_vec", dim, tree))
    Qb = materialize(_with_leaf(Q, "q_vec", dim, tree))

    # 1. radius from the own leaf and its sibling
    pair = F.shiftright("leaf", 1).alias("band")
    cand1 = merge(block_topk(Qb.select("_g", pair, "q_id", "q_vec"), Rb.select("_g", pair, "r_id", "r_vec"),
                             k, metric, exclude_self), k)
    # written once: pass 2 reads it for its slice counts and for its queries
    radius = materialize(cand1.groupBy("_g", "q_id").agg(F.max("dist").alias("_r"), F.count(F.lit(1)).alias("_c")))
    # the slack covers rounding in the distances of boxes
    Qr = (Qb.join(radius, ["_g", "q_id"], "left")
          .withColumn("_r", F.when(F.col("_c") >= k, F.col("_r") * F.lit(1 + 1e-9) + F.lit(1e-12))
                      .otherwise(F.lit(math.inf))))

    # 2. exact: all leaves within r
    Qr = _visits(Qr, _boxes(Rb, dim), dim, metric)
    if share_only:
        sizes = Rb.groupBy("_g", F.col("leaf").alias("band")).agg(F.count(F.lit(1)).alias("n"))
        pairs = Qr.select("_g", "band").join(sizes, ["_g", "band"]).agg(F.sum("n")).first()[0]
        total = Q.groupBy("_g").count().join(R.groupBy("_g").agg(F.count(F.lit(1)).alias("n")), "_g") \
            .agg(F.sum(F.col("count") * F.col("n"))).first()[0]
        return (pairs or 0) / (total or 1)
    cand2 = block_topk(materialize(Qr), Rb.select("_g", F.col("leaf").alias("band"), "r_id", "r_vec"),
                       k, metric, exclude_self)
    out = merge(cand2, k)
    keep = [F.col("_g").alias(group)] if group else []
    return out.select(*keep, "q_id", "r_id", "dist", "rank")


def candidate_share(queries: DataFrame, refs: DataFrame, k: int, **options) -> float:
    """Share of all (query, reference) pairs that the exact join compares: 1 means that the
    bands prune nothing."""
    return knn_join(queries, refs, k, share_only=True, **options)


QUERY_CHUNK = 32     # queries per distance block inside one task; a block stays in the cache


def _nearest(D: np.ndarray, k: int, limit: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest of each row, ties by column; only those within the row's limit."""
    if limit is None or not np.isfinite(limit).all():
        kth = np.partition(D, k - 1, axis=1)[:, k - 1]  # NaN sorts last
        limit = kth if limit is None else np.fmin(kth, limit)
        limit = np.where(np.isnan(limit), np.inf, limit)
    rows, cols = np.nonzero(D <= limit[:, None])
    order = np.lexsort((cols, D[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], cols[place < k]


def _block_topk_fn(k: int, metric: str, exclude_self: bool):
    import pandas as pd

    def fn(key, qdf: pd.DataFrame, rdf: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"_g": pd.Series(dtype="int64"), "q_id": pd.Series(dtype="int64"),
                              "r_id": pd.Series(dtype="int64"), "dist": pd.Series(dtype="float64")})
        if qdf.empty or rdf.empty:
            return empty
        rdf = rdf.drop_duplicates("r_id").sort_values("r_id", kind="stable")
        r_ids = rdf["r_id"].to_numpy(np.int64)
        R = np.ascontiguousarray(np.stack(rdf["r_vec"].to_numpy()).astype(np.float64).T)
        q_all = qdf.drop_duplicates("q_id")
        asked = q_all["q_id"].to_numpy(np.int64)
        vectors = np.stack(q_all["q_vec"].to_numpy()).astype(np.float64)
        limits = q_all["_r"].to_numpy(np.float64) if "_r" in q_all else None
        kk = min(k, len(r_ids))
        out = []
        for lo in range(0, len(asked), QUERY_CHUNK):
            q_ids, Q = asked[lo:lo + QUERY_CHUNK], vectors[lo:lo + QUERY_CHUNK]
            D, diff = np.zeros((len(Q), len(r_ids))), np.empty((len(Q), len(r_ids)))
            for i in range(len(R)):          # left-to-right over coordinates
                np.subtract(Q[:, i:i + 1], R[i], out=diff)
                D += np.abs(diff, out=diff) if metric == "l1" else np.multiply(diff, diff, out=diff)
            if metric != "l1":
                D = np.sqrt(D)
            if exclude_self:
                D[q_ids[:, None] == r_ids[None, :]] = np.inf
            rows, cols = _nearest(D, kk, None if limits is None else limits[lo:lo + QUERY_CHUNK])
            d = D[rows, cols]
            keep = np.isfinite(d)
            out.append((q_ids[rows][keep], r_ids[cols][keep], d[keep]))
        q, r, d = (np.concatenate(x) for x in zip(*out, strict=True))
        return pd.DataFrame({"_g": np.full(len(q), int(key[0]), dtype=np.int64), "q_id": q, "r_id": r, "dist": d})

    return fn


def knn_classify(neighbors: DataFrame, ref_labels: DataFrame, r_id: str = "id",
                 label: str = "label", group: str | None = None) -> DataFrame:
    """Distance-weighted vote: (q_id, score = P(class 1), pred).

    Weights 1/d; if some neighbours are at distance 0 they share all weight.
    ``pred`` is 1 only when P(1) > 0.5 (a tie goes to class 0).
    """
    gk = [group] if group else []
    j = neighbors.join(ref_labels.select(*gk, F.col(r_id).alias("r_id"), F.col(label).alias("_y")), gk + ["r_id"])
    zero = F.col("dist") == 0
    g = j.groupBy(*gk, "q_id").agg(
        F.sum(F.when(zero, 1.0).otherwise(0.0)).alias("_nz"),
        F.sum(F.when(zero & (F.col("_y") == 1), 1.0).otherwise(0.0)).alias("_nz1"),
        F.sum(F.when(~zero, F.lit(1.0) / F.col("dist"))).alias("_w"),
        F.sum(F.when(~zero & (F.col("_y") == 1), F.lit(1.0) / F.col("dist"))).alias("_w1"))
    score = F.when(F.col("_nz") > 0, F.col("_nz1") / F.col("_nz")) \
             .otherwise(F.coalesce(F.col("_w1"), F.lit(0.0)) / F.col("_w"))
    return g.select(*gk, "q_id", score.alias("score")).withColumn("pred", (F.col("score") > 0.5).cast("int"))
