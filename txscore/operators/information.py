"""Mutual information of features with a discrete label, as grouped and ordered jobs.

A score function takes (rows, features, discrete flags, label, id) and returns
(feature, mi); ``top_k`` selection accepts any of them.

* ``plug_in``: from the counts of (value, label); continuous features are cut into
  equal-width bins first.
* ``nearest``: discrete features as above, continuous ones by nearest neighbours: with
  r_i the distance of row i to its k-th nearest row of the same label, and m_i the rows of
  any label closer than r_i (row i included),

      mi = psi(n) + mean(psi(k_i)) - mean(psi(rows of its label)) - mean(psi(m_i)), at least 0.

  In one dimension the k nearest of a label lie within k places of a row in sorted order,
  so r_i comes from a distributed row number: blocks of places, with the rows next to them.
  m_i comes from the sorted values of the cells that x_i - r_i and x_i + r_i fall into (cuts
  near the quantiles) and the counts of the cells between: a row moves once for its block,
  once for its cell, and again only for an end in another cell. No pairs. Ties are broken by
  noise of 1e-10 of the scale, drawn from the hash of the row id; rows of one label, id and
  value are one row with all their neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.functions.hashing import DEFAULT_SEED, row_hash, uniform
from txscore.operators.ordered import join_small, ordered_row_number
from txscore.operators.prep import MI_BINS, mi_from_counts
from txscore.session import materialize

NEIGHBORS = 3   # fixed value of the source estimator
NOISE = 1e-10   # of the scale of a feature, to part equal values
BLOCK_ROWS = 1 << 14  # places of a label in one block
CELL_ROWS = 1 << 16   # rows of a feature in one cell, about
HELD_ROWS = 1 << 17   # rows that a task takes up at once, and whole groups at least

ScoreFunction = Callable[..., DataFrame]


def digamma(x: Column) -> Column:
    """psi(x) for x >= 1: ten recurrence steps, then the asymptotic series."""
    x = x.cast("double")
    shifted = x + F.lit(10.0)
    steps = sum((F.lit(1.0) / (x + F.lit(float(j))) for j in range(10)), F.lit(0.0))
    i2 = F.lit(1.0) / (shifted * shifted)
    series = i2 * (F.lit(1 / 12) - i2 * (F.lit(1 / 120) - i2 * (F.lit(1 / 252) - i2 * F.lit(1 / 240))))
    return F.log(shifted) - F.lit(0.5) / shifted - series - steps


def discrete_flags(features: Sequence[str], discrete: Sequence[str] | None = None) -> dict[str, bool]:
    """Which features are discrete: those given, else the one-hot columns (``cat__`` names)."""
    known = set(discrete) if discrete is not None else {f for f in features if f.startswith("cat__")}
    return {f: f in known for f in features}


def plug_in(rows: DataFrame, features: Sequence[str], discrete: dict[str, bool], label: str = "label",
            id_col: str = "tx_id", bins: int = MI_BINS) -> DataFrame:
    """(feature, mi) from counts; the table of counts is written once."""
    cut = [(f"{n}{i}", g(f)) for i, f in enumerate(features) if not discrete[f]
           for n, g in (("lo", F.min), ("hi", F.max))]
    ends = rows.agg(*[c.alias(n) for n, c in cut]).first() if cut else None
    cells = []
    for i, f in enumerate(features):
        lo, hi = (None, None) if discrete[f] else (ends[f"lo{i}"], ends[f"hi{i}"])
        if lo is None or lo == hi:
            cells.append(F.col(f).cast("double").alias(f))
        else:
            place = F.floor((F.col(f) - F.lit(float(lo))) * F.lit(float(bins)) / F.lit(float(hi) - float(lo)))
            cells.append(F.least(place, F.lit(bins - 1)).cast("double").alias(f))
    long = rows.select(F.col(label).alias("y"), *cells).unpivot(["y"], list(features), "feature", "x")
    return mi_from_counts(materialize(long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("n"))))


def nearest(rows: DataFrame, features: Sequence[str], discrete: dict[str, bool], label: str = "label",
            id_col: str = "tx_id", k: int = NEIGHBORS, seed: int = DEFAULT_SEED) -> DataFrame:
    """(feature, mi) by counts for discrete features and nearest neighbours for the others."""
    rows = materialize(rows.select(id_col, label, *features))  # read several times
    numeric = [f for f in features if not discrete[f]]
    parts = [plug_in(rows, chosen, discrete, label, id_col)] if (
        chosen := [f for f in features if discrete[f]]) else []
    if numeric:
        scale = rows.agg(*[F.greatest(F.avg(F.abs(f)), F.lit(1.0)).alias(f"s{i}")
                           for i, f in enumerate(numeric)]).first()
        noisy = [F.col(f).cast("double") + (uniform(row_hash(id_col, seed, F.lit(f))) - F.lit(0.5))
                 * F.lit(NOISE * scale[f"s{i}"]) for i, f in enumerate(numeric)]
        places = [str(i) for i in range(len(numeric))]
        wide = materialize(rows.select(F.col(id_col).alias("id"), F.col(label).alias("y"),
                                       *[c.alias(i) for c, i in zip(noisy, places, strict=True)]))
        found = _continuous(wide.unpivot(["id", "y"], places, "feature", "x")
                            .withColumn("feature", F.col("feature").cast("int")), k)
        parts.append(found.select(F.array(*map(F.lit, numeric))[F.col("feature")].alias("feature"), "mi"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _whole(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of whole groups, from rows sorted by the integers ``keys``."""
    held, size, least = [], 0, HELD_ROWS
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < least:
            continue
        t = pa.Table.from_batches(held)
        first = int(_starts(t, keys)[-1])
        if first:
            yield t.slice(0, first)
        held, size = t.slice(first).to_batches(), t.num_rows - first
        least = max(HELD_ROWS, 2 * size)  # a group that is larger is joined a few times only
    if size:
        yield pa.Table.from_batches(held)


def _starts(t: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Places of the first rows of the groups."""
    new = np.ones(t.num_rows, bool)
    new[1:] = np.any([np.diff(t.column(c).to_numpy()) != 0 for c in keys], axis=0)
    return np.flatnonzero(new)


def _radii(t: pa.Table, k: int) -> np.ndarray:
    """The distance of each row of whole blocks (sorted by place) to its kk-th nearest of the block; NaN
    for rows without one, and for rows that are no first of their label, id and value."""
    x, kk = t.column("x").to_numpy(), t.column("kk").to_numpy()
    n, first = len(x), _starts(t, ["gid", "block"])
    size = np.diff(np.append(first, n))
    at = np.arange(n)
    place = at - np.repeat(first, size)
    left = np.repeat(size, size) - place - 1  # rows after it
    gaps = np.full((n, 2 * k), np.inf)
    for i in range(1, k + 1):
        gap = x[i:] - x[:-i]
        gaps[i:, i - 1] = np.where(place[i:] >= i, gap, np.inf)
        gaps[:-i, k + i - 1] = np.where(left[:-i] >= i, gap, np.inf)
    ids = t.column("id").combine_chunks()
    same = np.zeros(n, bool)  # as the row before
    if n > 1:
        equal = pa.compute.fill_null(pa.compute.equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False)
        same[1:] = equal & (x[1:] == x[:-1]) & (place[1:] > 0)
    gaps.sort(axis=1)
    out = gaps[at, np.maximum(kk, 1) - 1]
    run = np.cumsum(~same) - 1
    if same.any():  # the neighbours of all rows of a run together
        many = np.flatnonzero(np.bincount(run)[run] > 1)
        flat, of = gaps[many].ravel(), np.repeat(run[many], 2 * k)
        flat = flat[np.lexsort((flat, of))]  # runs stay in order
        begin = many[~same[many]]
        out[begin] = flat[np.searchsorted(of, run[begin]) + np.maximum(kk[begin], 1) - 1]
    none = pa.compute.is_null(ids).to_numpy(zero_copy_only=False)
    return np.where(same | none | (kk < 1), np.nan, out)


def _continuous(long: DataFrame, k: int) -> DataFrame:
    """(feature, mi) of (feature, id, y, x); features are integers."""
    placed = materialize(ordered_row_number(long, ["feature", "y"], [F.col("x"), F.col("id")], "place"))
    kind = dict(long.dtypes)["id"]
    # labels with a single row have no neighbour and are left out, as every row needs one
    sizes = placed.where("y is not null").groupBy("feature", "y").agg(F.count(F.lit(1)).alias("own"))
    sizes = sizes.withColumn("kk", F.least(F.lit(k), F.col("own") - 1).cast("int"))
    sizes = sizes.select("feature", "y", "kk", F.monotonically_increasing_id().alias("gid"),
                         F.when(F.col("kk") > 0, digamma(F.col("kk")) - digamma(F.col("own"))).alias("psi"))
    known = join_small(placed, sizes, ["feature", "y"], "left").select(
        "feature", "id", "x", "place", F.coalesce("gid", F.lit(-1)).alias("gid"),
        F.coalesce("kk", F.lit(0)).alias("kk"), F.coalesce("psi", F.lit(0.0)).alias("psi"))
    # a block has the rows next to it too: k for the neighbours, and k for rows that are one
    size, near = max(BLOCK_ROWS, 2 * k), 2 * k
    block = F.explode(F.array_distinct(F.array(*[F.expr(f"(place - 1 + {d}L) div {size}L") for d in (-near, 0, near)])))
    blocks = known.withColumn("block", block).repartition("gid", "block").sortWithinPartitions("gid", "block", "place")

    counted = placed.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a feature
    most = max([r.n for r in counted], default=0) // CELL_ROWS
    share = [i / (most + 1) for i in range(1, most + 1)]
    cuts = {r.feature: np.unique(r.c) for r in placed.groupBy("feature").agg(
        F.percentile_approx("x", F.array(*map(F.lit, share)), 10_000).alias("c")).collect()} if most else {}

    def cell(feature: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for f, c in cuts.items():
            own = np.flatnonzero(feature == f)
            out[own] = np.searchsorted(c, x[own], side="right")
        return out

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches, ["gid", "block"]):
            feature, x, place = (t.column(c).to_numpy() for c in ("feature", "x", "place"))
            r = _radii(t, k)
            # drawn in by the rounding of x - r and x + r, so that the neighbour at distance r
            # itself stays outside the open interval
            r = r - 1e-15 * (np.abs(x) + r)
            home, psi, ids = cell(feature, x), t.column("psi").to_numpy(), t.column("id").combine_chunks()
            own = (place - 1) // size == t.column("block").to_numpy()
            held, sides = ~np.isnan(r) & own, {}
            for name, end in (("lo", x - r), ("hi", x + r)):
                where = cell(feature, end)
                away = np.flatnonzero(held & (where != home))
                sides[name] = np.where(held & (where == home), end, np.nan)
                if len(away):
                    none = np.full(len(away), np.nan)
                    yield batch_of(feature[away], where[away], none, ids.take(pa.array(away)), np.isfinite(none), none,
                                   **{c: end[away] if c == name else none for c in ("lo", "hi")})
            at = np.flatnonzero(own)
            yield batch_of(feature[at], home[at], x[at], ids.take(pa.array(at)), held[at], psi[at],
                           sides["lo"][at], sides["hi"][at])

    def batch_of(feature, cells, x, ids, held, psi, lo, hi) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(feature), pa.array(cells), pa.array(x), ids, pa.array(held.astype(np.int64)),
             pa.array(np.where(held, psi, 0.0)), pa.array(lo), pa.array(hi)],
            ["feature", "cell", "x", "id", "one", "psi", "lo", "hi"])

    # x is NaN where a row is only an end of another cell's row, lo and hi where the end is elsewhere
    marks = materialize(blocks.mapInArrow(
        ends, f"feature int, cell long, x double, id {kind}, one long, psi double, lo double, hi double"))
    before: dict[tuple[int, int], int] = {}
    sums: dict[int, int] = {}
    for f, c, n in marks.groupBy("feature", "cell").agg(F.count(F.nanvl("x", F.lit(None))).alias("n")) \
            .orderBy("feature", "cell").collect():  # one row a cell
        before[f, c] = sums.get(f, 0)
        sums[f] = before[f, c] + n

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches, ["feature", "cell"]):
            starts = _starts(t, ["feature", "cell"]).tolist()
            feature, cells, x, lo, hi = (t.column(c).to_numpy() for c in ("feature", "cell", "x", "lo", "hi"))
            m = np.zeros(len(x), np.int64)
            for a, b in zip(starts, [*starts[1:], len(x)], strict=True):
                values, start = np.sort(x[a:b][~np.isnan(x[a:b])]), before[int(feature[a]), int(cells[a])]
                m[a:b] = np.where(np.isnan(hi[a:b]), 0, start + np.searchsorted(values, hi[a:b], side="left")) \
                    - np.where(np.isnan(lo[a:b]), 0, start + np.searchsorted(values, lo[a:b], side="right"))
            keep = np.flatnonzero((t.column("one").to_numpy() > 0) | ~np.isnan(lo) | ~np.isnan(hi))
            yield from t.select(["feature", "id", "one", "psi"]).take(pa.array(keep)) \
                .append_column("m", pa.array(m[keep])).combine_chunks().to_batches()

    rows = marks.repartition("feature", "cell").sortWithinPartitions("feature", "cell").mapInArrow(
        inside, f"feature int, id {kind}, one long, psi double, m long")
    rows = rows.groupBy("feature", "id").agg(*[F.sum(c).alias(c) for c in ("one", "psi", "m")])
    m = digamma(F.greatest(F.col("m"), F.lit(1)))
    psi = rows.groupBy("feature").agg(F.sum("one").alias("n"), F.sum("psi").alias("s"),
                                      F.sum(F.col("one") * m).alias("c")).where("n > 0")
    mi = digamma(F.col("n")) + (F.col("s") - F.col("c")) / F.col("n")
    return materialize(psi.select("feature", F.greatest(mi, F.lit(0.0)).alias("mi")))
