"""Decision trees and forests grown level by level as Spark aggregates.

Rows become binned vectors (quantile cuts), and equal vectors of a fit one weighted cell of
the cell table. A level of all trees of all fits is one job: a map leads every cell down the trees
grown so far and counts (open node, feature, bin) with partial sums in the task; the counts are
summed by node; running sums over the bins give the gain of each cut; and a grouped maximum
chooses the split of each node. What comes back to the driver is one row for each open node,
the model itself, whose size is checked. Rows are never sampled here.

If the cells are few (``HELD_CELLS``: those of a bounded sample) every task gets them and a share
of the trees, so that its counts are whole and it chooses the splits itself; of larger tables no
task holds more than a part.

A node may look at a random subset of the features (a forest), or at one random cut of each
feature (the random splitter). Both draws are hashes of (seed, tree, place), so a lost task
computes the same again. Gains are Gini or entropy reductions times the node's weight; ties go to
the first feature, then the lowest cut.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.functions.hashing import DEFAULT_SEED
from txscore.session import materialize, shuffle_partitions

BINS = 32
#: Bins that a key has room for.
WIDTH = 64
#: Pairs of a cell and a tree that a task leads down together, and cells that it takes up at once.
PAIRS, HELD_CELLS = 1 << 20, 1 << 16
#: Counts of a tree's nodes that a task looks at together.
NODE_COUNTS = 1 << 18
#: Pairs, and counts of cells, that make a task of their own; small levels get few tasks.
TASK_PAIRS, TASK_COUNTS = 1 << 17, 1 << 16
#: Bytes of the trees that go to the tasks.
MODEL_BYTES = 256 << 20
NODE = {"feature": np.int64, "bin": np.int64, "left": np.int64, "right": np.int64, "n": float, "pos": float,
        "gain": float, "tree": np.int64, "parent": np.int64}


@dataclass(frozen=True)
class Plan:
    """How trees grow. ``features``: looked at by a node (None: all)."""
    trees: int = 1
    criterion: str = "gini"
    features: int | None = None
    random_cut: bool = False
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    seed: int = DEFAULT_SEED


def cell_table(rows: DataFrame, features: Sequence[str], fit: str | None = None, label: str = "label",
               bins: int = BINS) -> tuple[DataFrame, dict[int, list[np.ndarray]]]:
    """(fit, bins, n, pos): one row for each different binned vector of a fit, and the cuts by fit
    and feature. A missing value falls into the last bin."""
    known = rows.where(F.col(label).isNotNull())
    cuts = cut_table(known, features, fit, bins)
    y = known.withColumn("_y", (F.col(label) == 1).cast("double"))
    cells = bin_rows(y, features, cuts, fit, {"_y": "y double"}).groupBy("fit", "bins") \
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("pos"))
    return materialize(cells), cuts


def _values(features: Sequence[str], fit: str | None) -> list[Column]:
    """The fit and the features x0, x1, ... as doubles, NaN as null."""
    own = F.col(fit).cast("int") if fit else F.lit(0)
    return [own.alias("fit"), *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(features)]]


def cut_table(rows: DataFrame, features: Sequence[str], fit: str | None = None, bins: int = BINS) -> dict[int, list[np.ndarray]]:
    """The cuts between bins by fit and feature: quantiles of all rows."""
    if bins > WIDTH - 1:
        raise ValueError(f"at most {WIDTH - 1} bins")
    share = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = rows.select(*_values(features, fit)).groupBy("fit").agg(
        *[F.percentile_approx(f"x{i}", share, 10_000).alias(f"x{i}") for i in range(len(features))]).collect()  # a row a fit
    return {r.fit: [np.unique(r[f"x{i}"] or []) for i in range(len(features))] for r in found}


def bin_rows(rows: DataFrame, features: Sequence[str], cuts: dict[int, list[np.ndarray]], fit: str | None,
             keep: dict[str, str]) -> DataFrame:
    """(fit, bins, kept columns) of every row; ``keep``: a column's name and, for the result, its name and type."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            fits = part.column("fit").to_numpy()
            out = np.zeros((len(fits), len(features)), np.uint8)
            for i in range(len(features)):
                x = part.column(f"x{i}").to_numpy(zero_copy_only=False)
                for g in np.unique(fits):
                    at = fits == g
                    out[at, i] = np.where(np.isnan(x[at]), len(cuts[g][i]), np.searchsorted(cuts[g][i], x[at]))
            own = [part.column("fit"), pa.array(list(map(bytes, out)), pa.binary()), *[part.column(c) for c in keep]]
            yield pa.RecordBatch.from_arrays(own, ["fit", "bins", *[k.split()[0] for k in keep.values()]])

    return rows.select(*_values(features, fit), *keep).mapInArrow(run, ", ".join(["fit int, bins binary", *keep.values()]))


def _impurity(pos: Column, n: Column, criterion: str) -> Column:
    """Weight times impurity, up to a term that is linear in (pos, n) and so cancels in a gain."""
    if criterion == "gini":
        return -pos * pos / n
    p = pos / n
    return -n * sum((F.when(q > 0, q * F.log2(q)).otherwise(F.lit(0.0)) for q in (p, 1 - p)), F.lit(0.0))


def best_splits(counts: DataFrame, plan: Plan) -> DataFrame:
    """(node, slot, bin, n, pos, gain): the best cut of each node, with the weights left of it.
    ``counts``: (node, slot, bin, n, pos), slots in the order of the features."""
    by = Window.partitionBy("node", "slot")
    left = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = counts.select("node", "slot", "bin", *[F.sum(c).over(w).alias(f"{s}{c}") for c in ("n", "pos")
                                                  for s, w in (("l", left), ("t", by))])
    sums = sums.withColumns({"rn": F.col("tn") - F.col("ln"), "rpos": F.col("tpos") - F.col("lpos")})
    cuts = sums.where((F.col("ln") >= plan.min_leaf) & (F.col("rn") >= max(plan.min_leaf, 1)))
    if plan.random_cut:
        dice = F.row_number().over(by.orderBy(F.xxhash64(F.lit(plan.seed), "node", "slot", "bin")))
        cuts = cuts.withColumn("dice", dice).where("dice = 1")
    gain = _impurity(F.col("tpos"), F.col("tn"), plan.criterion) - sum(
        (_impurity(F.col(f"{s}pos"), F.col(f"{s}n"), plan.criterion) for s in "lr"), F.lit(0.0))
    cuts = cuts.withColumn("gain", F.round(gain, 9))
    top = F.max_by(F.struct("slot", "bin", F.col("ln").alias("n"), F.col("lpos").alias("pos"), "gain"),
                   F.struct("gain", (-F.col("slot")).alias("s"), (-F.col("bin")).alias("b")))
    return cuts.groupBy("node").agg(top.alias("t")).select("node", "t.*").where("gain > 1e-9")


def _subsets(nodes: dict[str, np.ndarray], at: np.ndarray, d: int, plan: Plan) -> np.ndarray:
    """Features that each open node looks at, in order."""
    if plan.features is None or plan.features >= d:
        return np.tile(np.arange(d), (len(at), 1))
    # draws by node: a seeded generator for each tree would give the same sets for twins
    out = np.empty((len(at), plan.features), np.int64)
    for start in range(0, len(at), 1 << 16):
        own = np.random.default_rng([plan.seed, int(at[start]), len(at)]).random((len(at[start:start + (1 << 16)]), d))
        out[start:start + (1 << 16)] = np.sort(own.argsort(1)[:, :plan.features], axis=1)
    return out


def _live(nodes: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Whether a node is one of the open nodes ``at``, or above one."""
    live, up = np.zeros(len(nodes["n"]), bool), at
    while len(up):
        live[up] = True
        up = nodes["parent"][up]
        up = np.unique(up[up >= 0])
        up = up[~live[up]]
    return live


def _sent(session, model: dict):
    """The model as a broadcast of bytes, after a check of its size."""
    data = pickle.dumps(model)
    if len(data) > MODEL_BYTES:
        raise ValueError(f"the trees take over {MODEL_BYTES} bytes; grow fewer at a time")
    return session.sparkContext.broadcast(data)


def _count_cells(cells: DataFrame, nodes: dict[str, np.ndarray], roots: dict[int, np.ndarray], at: np.ndarray,
                 subset: np.ndarray) -> DataFrame:
    """(node, slot, bin, n, pos) of the open nodes ``at``; node: its place among these."""
    place = np.full(len(nodes["n"]), -1, np.int32)
    place[at] = np.arange(len(at))
    live = _live(nodes, at)
    roots = {g: own[live[own]] for g, own in roots.items()}
    model = {"live": live, "feature": nodes["feature"].astype(np.int16), "bin": nodes["bin"].astype(np.int16),
             "left": nodes["left"].astype(np.int32), "right": nodes["right"].astype(np.int32),
             "place": place, "subset": subset.astype(np.int16), "roots": roots}
    sent, slots = _sent(cells.sparkSession, model), subset.shape[1]

    def led(m: dict, bins: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place) of all pairs of a row and an open node it falls into."""
        row, node = np.repeat(np.arange(len(bins)), len(roots)), np.tile(roots, len(bins))
        rows, places = [], []
        while len(row):
            f = m["feature"][node]
            done = f < 0
            opened = m["place"][node[done]]
            rows.append(row[done][opened >= 0])
            places.append(opened[opened >= 0])
            row, node, f = row[~done], node[~done], f[~done]
            node = np.where(bins[row, f] <= m["bin"][node], m["left"][node], m["right"][node])
            alive = m["live"][node]
            row, node = row[alive], node[alive]
        return np.concatenate(rows), np.concatenate(places)

    def counted(m: dict, fits, bins, n, pos) -> Iterator[pa.RecordBatch]:
        keys, ns, ps = [], [], []
        for g in np.unique(fits):
            own = np.flatnonzero(fits == g)
            all_roots = m["roots"][int(g)]
            step = max(1, PAIRS // len(own))
            for i in range(0, len(all_roots), step):
                row, node = led(m, bins[own], all_roots[i:i + step])
                row = own[row]
                key = np.concatenate([(node.astype(np.int64) * slots + j) * WIDTH + bins[row, m["subset"][node, j]]
                                      for j in range(slots)])
                if not len(key):
                    continue
                low, span = key.min(), int(np.ptp(key)) + 1
                if span <= 8 * len(key):
                    of, key = key - low, np.arange(low, low + span)
                else:
                    key, of = np.unique(key, return_inverse=True)
                sums = [np.bincount(of, np.tile(x[row], slots), len(key)) for x in (n, pos)]
                held = sums[0] > 0
                keys.append(key[held])
                ns.append(sums[0][held])
                ps.append(sums[1][held])
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, ns, ps)], ["key", "n", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, held, size = pickle.loads(sent.value), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            raw = b"".join(t.column("bins").to_pylist())
            yield from counted(m, t.column("fit").to_numpy(), np.frombuffer(raw, np.uint8).reshape(t.num_rows, -1),
                               t.column("n").to_numpy(), t.column("pos").to_numpy())
            held.clear()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size > HELD_CELLS:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    counts = cells.mapInArrow(run, "key long, n double, pos double")
    counts = counts.select(F.expr(f"key div {WIDTH * slots}").alias("node"),
                           F.expr(f"key div {WIDTH} % {slots}").alias("slot"), (F.col("key") % WIDTH).alias("bin"), "n", "pos")
    return (counts.repartition(_few(cells.sparkSession, at, slots), "node")
            .groupBy("node", "slot", "bin").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")))


def _few(session, at: np.ndarray, slots: int) -> int:
    """Tasks that the counts of the open nodes are worth."""
    return max(1, min(shuffle_partitions(session), -(-len(at) * slots * 8 // TASK_COUNTS)))


def _held(cells: DataFrame, fits: list[int]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bins, n, pos) of the cells of each fit; at most ``HELD_CELLS`` cells in all."""
    rows = cells.select("fit", "bins", "n", "pos").toPandas()
    own = [rows[rows["fit"] == g] for g in fits]
    return [(np.frombuffer(b"".join(r["bins"]), np.uint8).reshape(len(r), -1), r["n"].to_numpy(), r["pos"].to_numpy())
            for r in own]


def _tree_splits(bins: np.ndarray, n: np.ndarray, pos: np.ndarray, feature: np.ndarray, cut: np.ndarray,
                 child: np.ndarray, subset: np.ndarray, plan: Plan) -> tuple[np.ndarray, ...]:
    """(place, slot, bin, n, pos, gain): the best cuts of the open nodes (feature -1) of a tree, as
    ``best_splits`` chooses them, from all cells of its fit. ``child``: left and right by turns, -1 where no
    open node is below; ``subset``: the features that the open nodes look at, in the order of the nodes."""
    d, slots, width = bins.shape[1], subset.shape[1], int(bins.max(initial=0)) + 1
    flat, opened = bins.ravel(), np.cumsum(feature < 0) - 1
    row, node, rows, places = np.arange(len(bins)), np.zeros(len(bins), np.int64), [], []
    while len(row):
        f = feature.take(node)
        done = f < 0
        if done.any():
            rows.append(row[done])
            places.append(opened.take(node[done]))
            row, node, f = row[~done], node[~done], f[~done]
        node = child.take(2 * node + (flat.take(row * d + f) > cut.take(node)))
        alive = node >= 0
        row, node = row[alive], node[alive]
    row, place = np.concatenate(rows), np.concatenate(places)
    step = max(1, NODE_COUNTS // (slots * width))
    if step < len(subset):
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
    out = []
    for first in range(0, len(subset), step):
        k = min(step, len(subset) - first)
        a, b = (0, len(row)) if step >= len(subset) else np.searchsorted(place, [first, first + k])
        own, at = row[a:b], place[a:b] - first
        key = ((at * slots)[:, None] + np.arange(slots)) * width
        key += flat.take((own * d)[:, None] + subset[first:first + k][at])
        ln, lpos = (np.bincount(key.ravel(), np.repeat(x[own], slots), k * slots * width)
                    .reshape(k, slots, width).cumsum(2) for x in (n, pos))
        tn, tpos = ln[:, :, -1:], lpos[:, :, -1:]
        rn, rpos = tn - ln, tpos - lpos
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = weight(tpos, tn, plan.criterion) - (weight(lpos, ln, plan.criterion) + weight(rpos, rn, plan.criterion))
        fits = (ln >= max(plan.min_leaf, 1)) & (rn >= max(plan.min_leaf, 1))
        gain = np.where(fits, np.round(gain, 9), -np.inf).reshape(k, -1)
        best = gain.argmax(1)  # the first feature, then the lowest cut
        top = np.flatnonzero(gain[np.arange(k), best] > 1e-9)
        best = best[top]
        out.append((top + first, best // width, best % width, ln.reshape(k, -1)[top, best],
                    lpos.reshape(k, -1)[top, best], gain[top, best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def weight(pos: np.ndarray, n: np.ndarray, criterion: str) -> np.ndarray:
    """``_impurity`` of arrays."""
    if criterion == "gini":
        return -pos * pos / n
    p = pos / n
    return -n * sum(np.where(q > 0, q * np.log2(q), 0.0) for q in (p, 1 - p))


def _splits_in_tasks(session, held, trees: int, tasks: int, nodes: dict[str, np.ndarray], at: np.ndarray,
                     subset: np.ndarray, plan: Plan):
    """The rows of ``best_splits`` in the same order, by tasks that take some of the ``trees`` each and all
    cells of a fit (the broadcast ``held``)."""
    place = np.full(len(nodes["n"]), -1, np.int64)
    place[at] = np.arange(len(at))
    idx = np.flatnonzero(_live(nodes, at))
    idx = idx[np.argsort(nodes["tree"][idx], kind="stable")]  # a tree's nodes together, its root first
    new = np.full(len(place) + 1, -1, np.int32)
    new[idx] = np.arange(len(idx))
    first = np.searchsorted(nodes["tree"][idx], np.arange(trees + 1))
    open_at = place[idx][nodes["feature"][idx] < 0]
    sent = _sent(session, {
        "feature": nodes["feature"][idx].astype(np.int16), "bin": nodes["bin"][idx].astype(np.int16),
        "child": np.stack([new[nodes["left"][idx]], new[nodes["right"][idx]]], 1), "first": first,
        "open": np.append(0, np.cumsum(nodes["feature"][idx] < 0))[first], "place": open_at,
        "subset": subset[open_at].astype(np.int16)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(sent.value)
        for tree in (t for part in batches for t in part.column(0).to_pylist()):
            a, b = m["first"][tree:tree + 2].tolist()
            if a == b:
                continue
            child, (lo, hi) = m["child"][a:b].astype(np.int64), m["open"][tree:tree + 2].tolist()
            found = _tree_splits(*held.value[tree // plan.trees], m["feature"][a:b].astype(np.int64),
                                 m["bin"][a:b].astype(np.int64), np.where(child < 0, -1, child - a).ravel(),
                                 m["subset"][lo:hi].astype(np.int64), plan)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (m["place"][lo:hi][found[0]], *found[1:])],
                                             ["node", "slot", "bin", "n", "pos", "gain"])

    rows = session.range(0, trees, 1, tasks).mapInArrow(run, "node long, slot long, bin long, n double, pos double, gain double")
    out = rows.repartition(_few(session, at, subset.shape[1]), "node").sortWithinPartitions("node").toPandas()  # a row a node
    sent.unpersist()
    return out


def grow(cells: DataFrame, plan: Plan, tree_ids: range | None = None) -> dict[int, dict[str, np.ndarray]]:
    """Nodes by fit, tree after tree: feature (-1: a leaf), bin, left, right, n, pos, gain, tree."""
    totals = cells.groupBy("fit").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"),
                                      F.first("bins").alias("bins")).orderBy("fit").collect()  # a row a fit
    if not totals:
        return {}
    trees, d = plan.trees, len(totals[0].bins)
    count = cells.count()
    pairs = count * trees
    # dealt anew at each level (the cells are few): a written table of few files would be a single task
    session = cells.sparkSession
    most = max(shuffle_partitions(session), session.sparkContext.defaultParallelism)
    tasks = max(1, min(most, -(-pairs // TASK_PAIRS)))
    held = None  # a random cut is drawn by a hash of Spark's
    if count <= HELD_CELLS and not plan.random_cut:
        held = session.sparkContext.broadcast(_held(cells, [t.fit for t in totals]))
    cells = cells.repartition(tasks, "fit", "bins")
    nodes = {k: np.zeros(0, t) for k, t in NODE.items()}

    def add(n, pos, tree, parent=-1) -> np.ndarray:
        new = {"feature": -1, "bin": -1, "left": -1, "right": -1, "n": n, "pos": pos, "gain": 0.0, "tree": tree,
               "parent": parent}
        first = len(nodes["n"])
        for k, t in NODE.items():
            nodes[k] = np.concatenate([nodes[k], np.broadcast_to(np.asarray(new[k], t), np.shape(n))])
        return np.arange(first, len(nodes["n"]))

    at = add(np.repeat([t.n for t in totals], trees), np.repeat([t.pos for t in totals], trees),
             np.arange(len(totals) * trees))
    roots = {t.fit: at[i * trees:(i + 1) * trees] for i, t in enumerate(totals)}
    depth = 0
    while plan.max_depth is None or depth < plan.max_depth:
        n, pos = nodes["n"][at], nodes["pos"][at]
        at = at[(n >= max(2, plan.min_split)) & (pos > 0) & (pos < n)]
        if not len(at):
            break
        subset = _subsets(nodes, at, d, plan)
        if held is None:
            found = best_splits(_count_cells(cells, nodes, roots, at, subset), plan).toPandas()  # a row a node
        else:
            found = _splits_in_tasks(session, held, len(totals) * trees, tasks, nodes, at, subset, plan)
        if found.empty:
            break
        place = found["node"].to_numpy()
        split = at[place]
        nodes["feature"][split] = subset[place, found["slot"].to_numpy()]
        nodes["bin"][split], nodes["gain"][split] = found["bin"].to_numpy(), found["gain"].to_numpy()
        ln, lpos, tree = found["n"].to_numpy(), found["pos"].to_numpy(), nodes["tree"][split]
        rn, rpos = nodes["n"][split] - ln, nodes["pos"][split] - lpos
        nodes["left"][split] = left = add(ln, lpos, tree, split)
        nodes["right"][split] = right = add(rn, rpos, tree, split)
        at, depth = np.concatenate([left, right]), depth + 1
    out = {}
    for i, t in enumerate(totals):  # each fit's nodes, tree after tree
        own = np.flatnonzero(nodes["tree"] // trees == i)
        own = own[np.argsort(nodes["tree"][own], kind="stable")]
        new = np.full(len(nodes["n"]) + 1, -1)
        new[own] = np.arange(len(own))
        part = {k: nodes[k][own] for k in NODE}
        for k in ("left", "right", "parent"):
            part[k] = new[part[k]]
        part["tree"] -= i * trees
        out[t.fit] = part
    return out
