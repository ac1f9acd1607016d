"""Approximate nearest neighbours by p-stable projections.

A vector is projected on random directions (Cauchy for L1, Gaussian for L2: differences of
projections are then spread as the distance is), and each projection is cut into cells of one
width. ``hashes`` cells together are a bucket of a table; there are ``tables`` of them. References lie in
one bucket of each table; a query looks into its own bucket and the ``probes`` next ones, those
behind the nearest cell walls. Candidates of a bucket are compared exactly, both sides cut into
slices as in the exact join, and the k best of all tables stay, with exact distances.

The width is a multiple of the typical distance of a k-th neighbour, measured on a bounded sample.
All rows are indexed. A query that finds fewer than k candidates goes through the exact join, so
every query has its k rows. ``neighbors.knn_join`` stays the exact mode; this one is worth its misses
where the bands of the exact join prune nothing (many independent dimensions, large references).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.functions.hashing import DEFAULT_SEED, row_hash
from txscore.operators.neighbors import block_topk, knn_join, merge
from txscore.session import materialize

TABLES, HASHES, PROBES = 16, 4, 4
#: Cell width in typical neighbour distances, and rows of the sample that measures these.
WIDTH, SAMPLE_QUERIES, SAMPLE_REFS = 4.0, 128, 2048


def projections(dim: int, metric: str, tables: int, hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(directions, offsets as shares of a cell, odd multipliers of the cells in a bucket's key)."""
    rng = np.random.default_rng(seed)
    draw = rng.standard_cauchy if metric == "l1" else rng.standard_normal
    return (draw((dim, tables * hashes)), rng.random(tables * hashes),
            rng.integers(1, 1 << 62, size=(tables, hashes)) * 2 + 1)


def typical_distance(queries: DataFrame, refs: DataFrame, k: int, metric: str) -> float:
    """Median distance of the k-th neighbour between two hash samples of bounded size."""
    q, r = (np.array([x.vec for x in df.orderBy(row_hash("id"), "id").limit(n).select("vec").collect()], float)
            for df, n in ((queries, SAMPLE_QUERIES), (refs, SAMPLE_REFS)))
    out = []
    for v in q:
        d = np.abs(r - v).sum(1) if metric == "l1" else np.sqrt(((r - v) ** 2).sum(1))
        d = np.sort(d[d > 0])[:k]
        out += d[-1:].tolist()
    return float(np.median(out)) if out else 1.0


def _bucketed(df: DataFrame, model, width: float, probes: int) -> DataFrame:
    """(id, vec, band): a row for each bucket of a vector, and for each it probes."""
    directions, offsets, odd = model
    tables, hashes = odd.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                x = np.array(part.column("vec").to_pylist(), float)
                at = x @ directions / width + offsets
                cell = np.floor(at)
                share = (at - cell).reshape(-1, tables, hashes)
                cell = cell.astype(np.int64).reshape(-1, tables, hashes)
                with np.errstate(over="ignore"):
                    key = (cell * odd).sum(axis=2) + np.arange(tables) * 7919
                    keys = [key]
                    walls = np.concatenate([share, 1 - share], axis=2)  # to the cell below, above
                    steps = np.concatenate([-odd, odd], axis=1)
                    near = np.argsort(walls, axis=2, kind="stable")[:, :, :probes]
                    keys += [key + np.take_along_axis(np.broadcast_to(steps, walls.shape), near[:, :, i:i + 1], 2)[:, :, 0]
                             for i in range(near.shape[2])]
                keys = np.concatenate(keys, axis=1)
                rows = pa.array(np.repeat(np.arange(len(x)), keys.shape[1]))
                yield pa.RecordBatch.from_arrays([part.column("id").take(rows), part.column("vec").take(rows),
                                                  pa.array(keys.ravel())], ["id", "vec", "band"])

    return df.mapInArrow(run, "id long, vec array<double>, band long")


def lsh_knn_join(queries: DataFrame, refs: DataFrame, k: int, q_id: str = "id", r_id: str = "id",
                 q_vec: str = "vec", r_vec: str = "vec", metric: str = "l1", exclude_self: bool = False,
                 tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, width: float | None = None,
                 seed: int = DEFAULT_SEED, share_only: bool = False):
    """(q_id, r_id, dist, rank) for k near references of every query: exact distances, nearly all of
    them the nearest. ``share_only``: the share of all pairs that is compared, instead."""
    if metric not in ("l1", "l2"):
        raise ValueError(metric)
    q, r = (df.select(F.col(i).cast("long").alias("id"), F.col(v).cast("array<double>").alias("vec"))
            for df, i, v in ((queries, q_id, q_vec), (refs, r_id, r_vec)))
    first = r.first()
    if first is None:
        return 0.0 if share_only else knn_empty(queries)
    width = width or WIDTH * typical_distance(q, r, k, metric)
    model = projections(len(first.vec), metric, tables, hashes, seed)
    zero = F.lit(0).cast("long").alias("_g")
    asked = materialize(_bucketed(q, model, width, probes)).select(
        zero, "band", F.col("id").alias("q_id"), F.col("vec").alias("q_vec"))
    held = materialize(_bucketed(r, model, width, 0)).select(
        zero, "band", F.col("id").alias("r_id"), F.col("vec").alias("r_vec"))
    if share_only:
        sizes = [df.groupBy("band").agg(F.count(F.lit(1)).alias(n)) for df, n in ((asked, "a"), (held, "h"))]
        pairs = sizes[0].join(sizes[1], "band").agg(F.sum(F.col("a") * F.col("h"))).first()[0] or 0
        return pairs / max(1, q.count() * r.count())
    best = block_topk(asked, held, k, metric, exclude_self).groupBy("_g", "q_id", "r_id").agg(F.min("dist").alias("dist"))
    found = materialize(merge(best, k).select("q_id", "r_id", "dist", "rank"))
    full = found.groupBy("q_id").count().where(F.col("count") >= k).select(F.col("q_id").alias("id"))
    short = materialize(q.join(full, "id", "left_anti"))
    if short.isEmpty():
        return found
    exact = knn_join(short, r, k, metric=metric, exclude_self=exclude_self)
    return found.join(short.select(F.col("id").alias("q_id")), "q_id", "left_anti").unionByName(exact)


def knn_empty(queries: DataFrame) -> DataFrame:
    return queries.sparkSession.createDataFrame([], "q_id long, r_id long, dist double, rank int")
