"""The tree families: fitted many fits at a time, stored as tables, scored in a map.

Every classifier is fitted on all labelled rows that it is given, with the tuned rounds and depth.

Small fits (at most ``SMALL_ROWS`` rows each):

* Decision trees (all folds at once) and forests grow level by level as Spark aggregates
  (``growth``). The many small forests of a cross-validation are fitted in tasks, a chunk of trees
  in each.
* AdaBoost runs over the weighted cells of equal binned rows (``samme``), one task for each fit.
* Boosted trees follow one another and are fitted in one task for each fit.

Larger fits are tasks of their own over binned rows in scratch files (``whole``): a chunk of a forest's
trees, or a model of another family. A cross-validation scores its rows in the same task and stores no model.

A fitted model is one row of a table for each chunk of trees (key columns, ``model``), which is saved
and loaded like any table. Scoring broadcasts the models that are small and maps over all rows; larger
ones stay a table, and rows meet them chunk after chunk.

Boosting and the forests in tasks share ``Grower``. With gradients g and curvatures h of the loss a
split gains

    GL**2 / (HL + lam) + GR**2 / (HR + lam) - G**2 / (H + lam)

which for g = y, h = 1, lam = 0 is the Gini reduction. Boosting rounds stop splitting where
half the gain does not exceed ``gamma``: a summed loss reduction, as in the tuned value.
"""

from __future__ import annotations

import functools
import io
import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.functions.hashing import DEFAULT_SEED, row_hash, uniform
from txscore.operators import growth, samme, whole
from txscore.operators.bayes import VAR_SMOOTHING, gnb_fit_grouped, gnb_transform_grouped
from txscore.operators.neighbors import knn_classify, knn_join
from txscore.operators.smote import smote
from txscore.session import materialize

#: Rows of the largest fit up to which all fits are small.
SMALL_ROWS = 10_000
#: Hex digits of a hash by which the bounded sample is counted out.
HASH_DIGITS = 3
#: Rows that one task of a cross-validation scores with one model, and its most tasks.
SCORE_ROWS, MAX_TASKS = 1 << 15, 4096
#: Fixed value of the tuned nearest-neighbour classifier.
NEIGHBOURS = 3
BINS = growth.BINS
#: Levels of a tree that rows are led down before those in a leaf are left out.
DROP_LEVELS = 3
#: Bytes of models that may be loaded at once, and that scoring sends to the tasks (compressed).
MODEL_BYTES, SENT_BYTES = 512 << 20, 16 << 20
#: Rows that a task scores with models that are not sent, and nodes of a stored chunk of trees.
SLICE_ROWS, CHUNK_NODES = 1 << 18, 1 << 20

# Tuned hyper-parameters of the source pipeline per family.
TUNED = {
    "DecisionTree": {"criterion": "entropy", "max_depth": None, "min_samples_leaf": 1,
                     "min_samples_split": 2, "splitter": "random"},
    "RandomForest": {"bootstrap": False, "criterion": "gini", "max_depth": None,
                     "min_samples_split": 5, "n_estimators": 1000},
    "AdaBoost": {"learning_rate": 1.0, "n_estimators": 5000},
    "XGBoost": {"gamma": 1.0, "learning_rate": 0.05, "max_depth": 15, "min_child_weight": 1,
                "n_estimators": 1000, "scale_pos_weight": 4, "subsample": 0.8},
}
FAMILIES = tuple(TUNED)
#: Trees of a forest that one task fits.
CHUNK_TREES = 125


def leaves(feature: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray, codes: np.ndarray,
           first: np.ndarray | None = None) -> np.ndarray:
    """The leaf of every row of ``codes`` in a tree: left if the row's code is at most the node's
    ``place``. ``first``: places of the rows in the flat codes, if known."""
    base = np.arange(len(codes)) * codes.shape[1] if first is None else first
    flat, inner, stay = codes.ravel(), feature >= 0, np.arange(len(feature))
    feature = np.where(inner, feature, 0)
    child = np.empty(2 * len(feature), np.int64)  # a leaf is its own child
    child[::2], child[1::2] = np.where(inner, left, stay), np.where(inner, right, stay)
    node, live, depth = np.zeros(len(codes), np.int64), None, 0
    at = node
    while len(at):
        at = child.take(2 * at + (flat.take(base + feature.take(at)) > place.take(at)))
        depth += 1
        if depth % DROP_LEVELS == 0:  # rows that have reached their leaf are left out
            if live is None:
                node = at
            else:
                node[live] = at
            on = inner.take(at)
            live = np.flatnonzero(on) if live is None else live[on]
            at, base = at[on], base[on]
    return node


@dataclass
class Trees:
    """Trees in flat arrays: node i splits ``feature[i]`` at ``cut[i]`` (left if the value is at
    most the cut) or, with feature -1, is a leaf of ``value[i]``; ``roots`` and ``weight`` by tree."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    roots: np.ndarray
    weight: np.ndarray
    bias: float = 0.0

    @functools.cached_property
    def places(self) -> tuple[list[np.ndarray], np.ndarray]:
        """The different cuts by feature, and the place of each node's cut among them."""
        count = int(self.feature.max(initial=-1)) + 1
        at = [np.flatnonzero(self.feature == f) for f in range(count)]
        cuts = [np.unique(self.cut[a]) for a in at]
        place = np.zeros(len(self.feature), np.int32)
        for a, c in zip(at, cuts, strict=True):
            place[a] = np.searchsorted(c, self.cut[a])
        return cuts, place

    def decision(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum of the trees' leaves; missing values go right."""
        out = np.full(len(x), self.bias)
        cuts, place = self.places
        # a value is at most a cut where its place is: codes compare like values, missing ones last
        codes = np.zeros((len(x), max(1, len(cuts))), np.min_scalar_type(max(map(len, cuts), default=0)))
        for f, c in enumerate(cuts):
            codes[:, f] = np.searchsorted(c, x[:, f])
        wide, first = codes.T.astype(np.intp), np.arange(len(x)) * codes.shape[1]
        ends = np.append(self.roots[1:], len(self.feature))
        for root, end, weight in zip(self.roots.tolist(), ends.tolist(), self.weight.tolist(), strict=True):
            feature, value = self.feature[root:end], weight * self.value[root:end]
            if len(feature) == 3 and feature[0] >= 0:  # a stump: its leaf by code
                f = feature[0]
                leaf = np.where(np.arange(len(cuts[f]) + 1) <= place[root], *(
                    value[side[root] - root] for side in (self.left, self.right)))
                out += leaf.take(wide[f])
                continue
            node = leaves(feature, place[root:end], self.left[root:end] - root, self.right[root:end] - root, codes, first)
            out += value.take(node)
        return out

    def gains(self, count: int) -> np.ndarray:
        """Trees x features: share of the tree's gain of the splits on each feature."""
        out, ends = np.zeros((len(self.roots), count)), np.append(self.roots[1:], len(self.feature))
        for own, a, b in zip(out, self.roots, ends, strict=True):
            inner = self.feature[a:b] >= 0
            per = np.bincount(self.feature[a:b][inner], self.gain[a:b][inner], count)
            if per.sum() > 0:
                own += per / per.sum()
        return out

    def importances(self, count: int) -> np.ndarray:
        """Share of the total gain of the splits on each feature, averaged over trees."""
        return mean_share(self.gains(count))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        small = {"feature": np.int16, "left": np.int32, "right": np.int32}  # of a chunk
        np.savez_compressed(out, **{f.name: np.asarray(getattr(self, f.name)).astype(small.get(f.name, float if f.name in (
            "cut", "value", "gain", "weight", "bias") else np.int64)) for f in fields(self)})
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Trees:
        with np.load(io.BytesIO(data)) as z:
            return Trees(**{k: float(z[k]) if k == "bias" else z[k].astype(np.int64) if z[k].dtype.kind == "i" else z[k]
                            for k in z.files})


def mean_share(gains: np.ndarray) -> np.ndarray:
    """Trees' shares by feature, added up in order, as shares of all."""
    total = np.zeros(gains.shape[1])
    for own in gains:
        total += own
    return total / max(total.sum(), 1e-300)


def join_trees(parts: Sequence[Trees]) -> Trees:
    """One ensemble of all parts' trees."""
    shift = np.cumsum([0, *(len(p.feature) for p in parts)])
    return Trees(
        **{k: np.concatenate([getattr(p, k) for p in parts]) for k in ("feature", "cut", "value", "gain", "weight")},
        **{k: np.concatenate([getattr(p, k) + s for p, s in zip(parts, shift, strict=False)])
           for k in ("left", "right", "roots")}, bias=parts[0].bias)


def bin_features(x: np.ndarray, bins: int = BINS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bin numbers and, by feature, the cuts between bins (at most bins - 1)."""
    cuts, out = [], np.empty(x.shape, np.int64)
    for f in range(x.shape[1]):
        known = x[~np.isnan(x[:, f]), f]
        edge = np.unique(np.quantile(known, np.arange(1, bins) / bins, method="lower")) if len(known) else known
        cuts.append(edge)
        out[:, f] = np.where(np.isnan(x[:, f]), len(edge), np.searchsorted(edge, x[:, f]))
    return out, cuts


class Grower:
    """Grows trees over one binned sample."""

    def __init__(self, x: np.ndarray, bins: int = BINS):
        self.binned, self.cuts = bin_features(x, bins)
        self.n, self.f = x.shape
        self.bins = bins
        # no split after the last bin that a feature has
        self.open = np.array([[b < len(c) for b in range(bins)] for c in self.cuts])
        self.edges = np.array([[c[b] if b < len(c) else np.nan for b in range(bins)] for c in self.cuts])

    def tree(self, g: np.ndarray, h: np.ndarray, rows: np.ndarray, max_depth: int | None = None,
             lam: float = 0.0, gamma: float = 0.0, least_h: float = 0.0, min_split: int = 2,
             features: int | None = None, rng: np.random.Generator | None = None) -> dict[str, np.ndarray]:
        nodes: dict[str, list] = {k: [] for k in ("feature", "cut", "bin", "left", "right", "value", "gain")}

        def add(value: np.ndarray) -> None:
            for k, v in (("feature", -1), ("cut", 0.0), ("bin", -1), ("left", -1), ("right", -1), ("gain", 0.0)):
                nodes[k].append(np.full(len(value), v))
            nodes["value"].append(value)

        node = np.zeros(len(rows), np.int64)  # place in this level
        add(np.array([g[rows].sum() / max(h[rows].sum() + lam, 1e-12)]))
        some = features is not None and features < self.f
        width, end, depth = features if some else self.f, 1, 0
        while len(rows) and (max_depth is None or depth < max_depth):
            k, depth = len(nodes["value"][-1]), depth + 1
            if some:  # a node counts only the features that it looks at
                looked = np.sort(rng.random((self.f, k)).argsort(0)[:width].T, axis=1)
                own = np.take(self.binned.ravel(), (rows * self.f)[:, None] + looked[node])
            else:
                looked, own = np.broadcast_to(np.arange(self.f), (k, self.f)), self.binned[rows]
            at = ((node * width)[:, None] + np.arange(width)) * self.bins + own
            shape, size = (k, width, self.bins), k * width * self.bins
            gs = np.bincount(at.ravel(), np.repeat(g[rows], width), size).reshape(shape).cumsum(2)
            hs = np.bincount(at.ravel(), np.repeat(h[rows], width), size).reshape(shape).cumsum(2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gr, hr = gt - gs, ht - hs
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = gs**2 / (hs + lam) + gr**2 / (hr + lam) - gt**2 / (ht + lam)
            least = max(least_h, 1e-12)
            ok = (hs >= least) & (hr >= least) & (self.open[looked] if some else self.open)
            gain = np.where(ok, gain, -np.inf).reshape(k, -1)
            best = gain.argmax(1)
            top = gain[np.arange(k), best]
            counts = np.bincount(node, minlength=k)
            split = (0.5 * top > gamma) & (top > 1e-10) & (counts >= min_split)
            if not split.any():
                break
            spots = np.flatnonzero(split)
            slot, b = best // self.bins, best % self.bins
            f = looked[np.arange(k), slot]
            lg, lh = gs[spots, slot[spots], b[spots]], hs[spots, slot[spots], b[spots]]
            rg, rh = gr[spots, slot[spots], b[spots]], hr[spots, slot[spots], b[spots]]
            values = np.column_stack([lg / np.maximum(lh + lam, 1e-12), rg / np.maximum(rh + lam, 1e-12)]).ravel()
            nodes["feature"][-1][spots] = f[spots]
            nodes["cut"][-1][spots] = self.edges[f[spots], b[spots]]
            nodes["bin"][-1][spots] = b[spots]
            nodes["left"][-1][spots] = end + 2 * np.arange(len(spots))
            nodes["right"][-1][spots] = end + 2 * np.arange(len(spots)) + 1
            nodes["gain"][-1][spots] = top[spots]
            add(values)
            end += len(values)
            place = np.cumsum(split) - 1
            go = split[node]
            rows, node = rows[go], node[go]
            right = self.binned[rows, f[node]] > b[node]
            node = 2 * place[node] + right
        return {k: np.concatenate(v).astype(float if k in ("cut", "value", "gain") else np.int64)
                for k, v in nodes.items()}


def assemble(trees: list[dict[str, np.ndarray]], weight: Sequence[float], bias: float = 0.0) -> Trees:
    sizes = np.cumsum([0, *(len(t["value"]) for t in trees)])
    parts = [Trees(**{k: t[k] for k in ("feature", "cut", "left", "right", "value", "gain")},
                   roots=np.zeros(1, np.int64), weight=np.array([w])) for t, w in zip(trees, weight, strict=True)]
    if not parts:
        empty, none = np.zeros(0), np.zeros(0, np.int64)
        return Trees(none, empty, none, none, empty, empty, none, empty, bias)
    out = join_trees(parts)
    out.roots, out.bias = sizes[:-1], bias
    return out


def seeds(n: int, seed: int, first: int = 0) -> Iterator[np.random.Generator]:
    for i in range(first, first + n):
        yield np.random.default_rng([seed, i])


def fit_boosted(x: np.ndarray, y: np.ndarray, n_estimators: int, max_depth: int, learning_rate: float,
                gamma: float, min_child_weight: float, scale_pos_weight: float, subsample: float,
                lam: float = 1.0, seed: int = DEFAULT_SEED) -> Trees:
    """Second-order boosting of the logistic loss."""
    grower, w = Grower(x), np.where(y == 1, scale_pos_weight, 1.0)
    margin, trees = np.zeros(len(y)), []
    for rng in seeds(n_estimators, seed):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(rng.random(len(y)) < subsample)
        t = grower.tree(w * (y - p), w * p * (1 - p), rows, max_depth, lam, gamma, min_child_weight)
        trees.append(t)
        at = leaves(t["feature"], t["bin"], t["left"], t["right"], grower.binned)
        margin += learning_rate * t["value"][at]
    return assemble(trees, [learning_rate] * len(trees))


def fit_forest(x: np.ndarray, y: np.ndarray, n_estimators: int, max_depth: int | None,
               min_samples_split: int, first: int = 0, seed: int = DEFAULT_SEED, **_) -> Trees:
    """Gini trees over all rows, each split among a random subset of the features."""
    grower, ones, rows = Grower(x), np.ones(len(y)), np.arange(len(y))
    features = max(1, int(np.sqrt(x.shape[1])))
    trees = [grower.tree(y.astype(float), ones, rows, max_depth, min_split=min_samples_split,
                         features=features, rng=rng) for rng in seeds(n_estimators, seed, first)]
    return assemble(trees, [1.0] * len(trees))


def fit(family: str, x: np.ndarray, y: np.ndarray, **params) -> Trees:
    """Boosted trees or a forest (chunk) on rows in memory."""
    p = TUNED[family] | params
    if family == "XGBoost":
        return fit_boosted(x, y, **p)
    return fit_forest(x, y, p["n_estimators"], p["max_depth"], p["min_samples_split"], p.get("first", 0))


def probability(family: str, model: Trees, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, predicted class) of rows."""
    return of_decision(family, model.decision(x), len(model.roots))


def of_decision(family: str, d: np.ndarray, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """(score, predicted class) from the sum of all ``trees``."""
    if family in ("XGBoost", "AdaBoost"):
        return 1 / (1 + np.exp(-d)), (d > 0).astype(np.int32)
    score = d / max(1, trees) if family == "RandomForest" else d
    return score, (score > 0.5).astype(np.int32)


# --- on Spark ------------------------------------------------------------------------

def fit_sample(train: DataFrame, id_col: str = "tx_id", label: str = "label", n: int | None = None,
               seed: int = DEFAULT_SEED, by: Sequence[str] = ()) -> DataFrame:
    """All labelled rows. Only a caller that names ``n`` gets at most so many (of each group ``by``),
    picked by the hash of their id; every class keeps its share, and at least one row."""
    keys = [*by, label]
    known = train.where(F.col(label).isNotNull())
    if n is None:
        return known
    groups: dict[tuple, dict] = {}
    for *group, cls, count in known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).collect():  # groups x classes
        groups.setdefault(tuple(group), {})[cls] = count
    quotas = []
    for group, counts in groups.items():
        total = sum(counts.values())
        take = {c: k if total <= n else max(1, k * n // total) for c, k in counts.items()}
        largest = max(take, key=lambda c: (take[c], str(c)))
        take[largest] -= max(0, sum(take.values()) - n)
        quotas += [(*group, c, k) for c, k in take.items()]
    if all(sum(c.values()) <= n for c in groups.values()):
        return known
    kinds = dict(train.dtypes)
    table = train.sparkSession.createDataFrame(quotas, ", ".join([*(f"{c} {kinds[c]}" for c in keys), "_k long"]))
    # Only rows up to the hash bucket that holds the last one wanted are ranked, so that a rank's group is
    # bounded too. The bucket is counted: a part of a split holds hashes of one range only.
    hashed = known.withColumn("_h", row_hash(id_col, seed)).withColumn("_b", F.substring("_h", 1, HASH_DIGITS))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = hashed.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c")) \
        .withColumn("_c", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    last = buckets.join(F.broadcast(table), keys).where(F.col("_c") < F.col("_k")) \
        .groupBy(*keys).agg(F.max("_b").alias("_last"), F.first("_k").alias("_k"))
    order = Window.partitionBy(*keys).orderBy("_h", id_col)
    near = hashed.join(F.broadcast(last), keys).where(F.col("_b") <= F.col("_last"))
    return near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= F.col("_k")).select(*train.columns)


def fit_table(sample: DataFrame, features: Sequence[str], families: Sequence[str] = FAMILIES,
              params: dict[str, dict] | None = None, label: str = "label", id_col: str = "tx_id",
              by: Sequence[str] = (), cells: tuple | None = None) -> DataFrame:
    """(by..., family, chunk, model): every family fitted on every group of the sample.

    ``by``: nothing, or one integer column. ``cells``: the sample's ``growth.cell_table``, if
    there is one already (of small fits)."""
    params, features, by = params or {}, list(features), list(by)
    own = {f: TUNED[f] | params.get(f, {}) for f in families}
    if cells is None and largest_fit(sample, label, by) > SMALL_ROWS:
        return _fitted_whole(sample.where(F.col(label).isNotNull()), features, own, label, id_col, by)
    # many small forests go to tasks, everything else of these families to the level-wise growth
    grown = [f for f in own if f == "DecisionTree" or f == "RandomForest" and not by]
    parts = []
    if grown or "AdaBoost" in own:
        cells = cells or growth.cell_table(sample, features, by[0] if by else None, label)
        parts += [_grown(*cells, f, own[f], len(features), by) for f in grown]
    if "AdaBoost" in own:
        parts.append(_boosted_cells(*cells, own["AdaBoost"], by))
    if in_tasks := {f: p for f, p in own.items() if f not in grown and f != "AdaBoost"}:
        parts.append(_fitted_in_tasks(sample, features, in_tasks, label, id_col, by))
    return functools.reduce(DataFrame.unionByName, parts)


def largest_fit(rows: DataFrame, label: str = "label", by: Sequence[str] = ()) -> int:
    """Labelled rows of the largest group."""
    known = rows.where(F.col(label).isNotNull())
    return known.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


@dataclass(frozen=True)
class Job:
    """What one task fits on the rows of a fit: a model, or ``trees`` trees of a forest from ``first`` on."""
    family: str
    params: dict
    name: str = ""
    first: int = 0
    trees: int = 0

    def plan(self, d: int) -> growth.Plan:
        return forest_plan(self.params, d) if self.family == "RandomForest" else tree_plan(self.params)

    def fitted(self, rows: whole.Rows, cuts: Sequence[np.ndarray], score: bool) -> tuple[Iterator[dict], np.ndarray]:
        """The trees, found one after the other, and the decision of all rows, which follows them."""
        p, d = self.params, rows.scratch()
        if self.family == "XGBoost":
            return whole.boost(rows, cuts, **p, margin=d, rngs=seeds(p["n_estimators"], DEFAULT_SEED)), d
        grown = (whole.grow_tree(rows, cuts, self.plan(rows.d), rng, d if score else None)
                 for rng in seeds(max(1, self.trees), DEFAULT_SEED, self.first))
        return grown, d


def _jobs(family: str, p: dict, name: str = "", chunk: int | None = None) -> list[Job]:
    if family != "RandomForest":
        return [Job(family, p, name)]
    n, step = p["n_estimators"], chunk or p["n_estimators"]
    return [Job(family, p, name, first, min(step, n - first)) for first in range(0, n, step)]


def _shared(jobs: list[Job], fits: int, cores: int) -> list[list[Job]]:
    """The jobs of a fit as tasks: each gets a copy of the fit's rows, so there are no more than twice the cores
    ask for. Long jobs first; the next goes to the task that has least to do."""
    cost = {"XGBoost": 4, "RandomForest": 4, "AdaBoost": 2, "DecisionTree": 1}
    tasks = [[] for _ in range(min(len(jobs), max(1, -(-2 * cores // max(1, fits)))))]
    for job in sorted(jobs, key=lambda j: -cost[j.family]):
        min(tasks, key=lambda t: sum(cost[j.family] for j in t)).append(job)
    return tasks


def _dealt(binned: DataFrame, fits: Sequence[int], tasks: Sequence[list[Job]], order: Sequence[str]) -> DataFrame:
    """``binned`` once for each task of its fit, every copy a part of its own; the first tasks' parts start first."""
    place = F.create_map(*[x for i, g in enumerate(fits) for x in (F.lit(g), F.lit(i))])[F.col("fit")] if fits else F.lit(0)
    copies = binned.withColumn("_task", F.explode(F.array(*[F.lit(i) for i in range(len(tasks))]))) \
        .withColumn("_part", (F.col("_task") * len(fits) + place).cast("int"))
    return copies.repartitionById(max(1, len(fits) * len(tasks)), F.col("_part")).sortWithinPartitions("kind", *order)


def _kind(label: str):
    return F.when(F.col(label) == 1, whole.POSITIVE).otherwise(whole.OTHER)


def _spooled(batches: Iterator[pa.RecordBatch], d: int, fits: Sequence[int], tasks: Sequence[list[Job]],
             keep: Sequence[str] = ()) -> tuple[int, list[Job], whole.Rows] | None:
    """(fit, jobs, rows) of a part of ``_dealt``; None if it is empty."""
    head = next((b for b in batches if b.num_rows), None)
    if head is None:
        return None
    part = head.column("_part")[0].as_py()
    batches = itertools.chain([head], (b for b in batches if b.num_rows))
    return fits[part % len(fits)], tasks[part // len(fits)], whole.Rows(batches, d, keep)


def _fitted_whole(rows: DataFrame, features: list[str], own: dict[str, dict], label: str, id_col: str,
                  by: list[str]) -> DataFrame:
    """``fit_table`` of larger fits."""
    fit, d = by[0] if by else None, len(features)
    cuts = growth.cut_table(rows, features, fit)
    fits = sorted(cuts)
    tasks = _shared([j for f, p in own.items() for j in _jobs(f, p, chunk=CHUNK_TREES)], len(fits),
                    rows.sparkSession.sparkContext.defaultParallelism)
    binned = growth.bin_rows(rows.withColumn("_kind", _kind(label)), features, cuts, fit, {
        "_kind": "kind int", id_col: f"id {dict(rows.dtypes)[id_col]}"})
    cols = [*(["fit"] if by else []), "family", "chunk", "model"]

    def chunks(found: Iterator[dict], job: Job, weight: float) -> Iterator[tuple[int, Trees]]:
        held, first, size = [], job.first, 0
        for tree in found:
            held.append(tree)
            size += len(tree["value"])
            if size >= CHUNK_NODES:
                yield first, assemble(held, [weight] * len(held))
                held, first, size = [], first + len(held), 0
        if held:
            yield first, assemble(held, [weight] * len(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _spooled(batches, d, fits, tasks)
        if found is None:
            return
        g, jobs, spooled = found
        for job in jobs:
            if job.family == "AdaBoost":
                stumps = whole.boost_stumps(spooled, job.params["n_estimators"], job.params["learning_rate"])
                parts = iter([(0, _stump_model(stumps, cuts[g]))])
            else:
                trees, _ = job.fitted(spooled, cuts[g], False)
                parts = chunks(trees, job, job.params["learning_rate"] if job.family == "XGBoost" else 1.0)
            for first, model in parts:
                row = [*([g] if by else []), job.family, first, model.to_bytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
                    row, [*([pa.int32()] if by else []), pa.string(), pa.int32(), pa.binary()], strict=True)], names=cols)

    schema = ", ".join([*(["fit int"] if by else []), "family string, chunk int, model binary"])
    out = _dealt(binned, fits, tasks, ["id", "bins"]).mapInArrow(run, schema)
    return out.withColumnRenamed("fit", by[0]) if by else out


def _stump_model(found: list[tuple], cuts: Sequence[np.ndarray]) -> Trees:
    alphas = np.array([x[-1] for x in found])
    return assemble(samme.stumps(found, cuts), alphas / (alphas.sum() or 1.0))


def forest_plan(p: dict, d: int) -> growth.Plan:
    return growth.Plan(p["n_estimators"], "gini", max(1, int(np.sqrt(d))), max_depth=p["max_depth"],
                       min_split=p["min_samples_split"])


def tree_plan(p: dict) -> growth.Plan:
    return growth.Plan(1, p["criterion"], random_cut=p["splitter"] == "random", max_depth=p["max_depth"],
                       min_split=p["min_samples_split"], min_leaf=p["min_samples_leaf"])


def _model_rows(spark, rows: list[tuple], by: Sequence[str]) -> DataFrame:
    """A model table from rows (group or (), family, chunk, model)."""
    schema = ", ".join([*(f"{c} int" for c in by), "family string, chunk int, model binary"])
    return spark.createDataFrame([(*g, f, c, bytearray(m)) for g, f, c, m in rows], schema)


def _grown(cells: DataFrame, cuts: dict, family: str, p: dict, d: int, by: Sequence[str]) -> DataFrame:
    plan = forest_plan(p, d) if family == "RandomForest" else tree_plan(p)
    rows = []
    for fit, nodes in growth.grow(cells, plan).items():
        for first in range(0, plan.trees, CHUNK_TREES):
            trees = from_nodes(nodes, cuts[fit], first, min(first + CHUNK_TREES, plan.trees))
            rows.append(((fit,) if by else (), family, first, trees.to_bytes()))
    return _model_rows(cells.sparkSession, rows, by)


def from_nodes(nodes: dict[str, np.ndarray], cuts: list[np.ndarray], first: int, stop: int) -> Trees:
    """Trees ``first`` to ``stop`` of a fit's grown nodes."""
    a, b = np.searchsorted(nodes["tree"], [first, stop])
    own = {k: v[a:b] for k, v in nodes.items()}
    inner = own["feature"] >= 0
    cut = np.zeros(b - a)
    cut[inner] = [cuts[f][i] for f, i in zip(own["feature"][inner], own["bin"][inner], strict=True)]
    roots = np.searchsorted(own["tree"], np.arange(first, stop))
    return Trees(own["feature"], cut, *(np.where(inner, own[k] - a, -1) for k in ("left", "right")),
                 own["pos"] / own["n"], own["gain"], roots, np.ones(stop - first))


def _boosted_cells(cells: DataFrame, cuts: dict, p: dict, by: Sequence[str]) -> DataFrame:
    """SAMME of every small fit, a task each, over its cells."""
    cols = [*by, "family", "chunk", "model"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows, g = rows.sort_values("bins", kind="stable"), int(rows["fit"].iloc[0])
        bins = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(len(rows), -1).astype(np.int64)
        n, pos = rows["n"].to_numpy(), rows["pos"].to_numpy()
        w, y = np.concatenate([pos, n - pos]), np.repeat([1, 0], len(rows))
        held = w > 0
        found = samme.fit_cells(np.concatenate([bins, bins])[held], y[held], w[held], p["n_estimators"],
                                p["learning_rate"])
        model = _stump_model(found, cuts[g])
        return pd.DataFrame([[*([g] if by else []), "AdaBoost", 0, model.to_bytes()]], columns=cols)

    schema = ", ".join([*(f"{c} int" for c in by), "family string, chunk int, model binary"])
    return cells.groupBy("fit").applyInPandas(run, schema)


def _fitted_in_tasks(sample: DataFrame, features: list[str], params: dict[str, dict], label: str, id_col: str,
                     by: list[str]) -> DataFrame:
    """Boosted trees, and the chunks of forests, of small fits, one group of a grouped map each. The rows
    are copied once for each."""
    jobs = []
    for family, p in params.items():
        step = CHUNK_TREES if family == "RandomForest" else p["n_estimators"]
        jobs += [(family, first) for first in range(0, p["n_estimators"], step)]
    cols = [*by, "family", "chunk"]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(id_col, kind="stable")
        family, first = key[-2], int(key[-1])
        p = dict(params[family])
        if family == "RandomForest":
            p |= {"n_estimators": min(CHUNK_TREES, p["n_estimators"] - first), "first": first}
        model = fit(family, rows[features].to_numpy(float), rows[label].to_numpy(), **p)
        return pd.DataFrame([[*key, model.to_bytes()]], columns=[*cols, "model"])

    todo = F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(c).alias("chunk")) for f, c in jobs]))
    copies = sample.select(*by, id_col, label, *[F.col(c).cast("double").alias(c) for c in features],
                           todo.alias("job")).select("*", "job.family", "job.chunk").drop("job")
    kinds = dict(sample.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), "family string", "chunk int", "model binary"])
    # as many tasks as fits: a fit is seconds of work on a few rows
    return (copies.repartition(max(1, len(jobs)) * (8 if by else 1), *cols)
            .groupBy(*cols).applyInPandas(run, schema))


def load_models(models: DataFrame, by: Sequence[str] = ()) -> dict[tuple, Trees]:
    """Fitted models by (by..., family); the table has one row for each fit or chunk. They are
    collected only within ``MODEL_BYTES``."""
    models = models.select(*by, "family", "chunk", "model").persist()
    size = models.agg(F.sum(F.octet_length("model"))).first()[0] or 0
    if size > MODEL_BYTES:
        raise ValueError(f"the models take {size} bytes, over {MODEL_BYTES}; load fewer at a time")
    parts: dict[tuple, list] = {}
    for r in models.collect():
        parts.setdefault(tuple(r[:-2]), []).append((r.chunk, bytes(r.model)))
    models.unpersist()
    return {k: join_trees([Trees.from_bytes(b) for _, b in sorted(v)]) for k, v in parts.items()}


def score_table(rows: DataFrame, models: dict[tuple, Trees], features: Sequence[str],
                keep: Sequence[str] = ("tx_id", "label"), by: Sequence[str] = ()) -> DataFrame:
    """(keep..., model, score, pred): every row scored by every family (of its group)."""
    features, keep, by = list(features), list(keep), list(by)
    kinds = dict(rows.dtypes)
    sent = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = sent.value
        for part in batches:
            groups = part.groupby(by, sort=True) if by else [((), part)]
            for key, rows in groups:
                key = tuple(key) if isinstance(key, tuple) else (key,)
                x = rows[features].to_numpy(float)
                for (*own, family), model in models.items():
                    if tuple(own) == key:
                        out = rows[keep].copy()
                        out["model"] = family
                        out["score"], out["pred"] = probability(family, model, x)
                        yield out

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in keep), "model string, score double, pred int"])
    cols = dict.fromkeys([*keep, *by])
    rows = rows.select(*cols, *[F.col(c).cast("double").alias(c) for c in features if c not in cols])
    # dealt out, as a small table may be one part, and a row is thousands of trees
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism).mapInPandas(run, schema)


def sent_models(table: DataFrame) -> dict[tuple, Trees]:
    """The models of a table (family, chunk, model) that are sent to the tasks: the smallest families,
    together at most ``SENT_BYTES``."""
    sizes = table.groupBy("family").agg(F.sum(F.octet_length("model")).alias("size")).orderBy("size", "family").collect()
    total = itertools.accumulate(r["size"] or 0 for r in sizes)
    few = [r.family for r, t in zip(sizes, total, strict=True) if t <= SENT_BYTES]
    return load_models(table.where(F.col("family").isin(few))) if few else {}


def score_models(rows: DataFrame, table: DataFrame, features: Sequence[str], keep: Sequence[str] = ("tx_id", "label"),
                 sent: dict[tuple, Trees] | None = None) -> DataFrame:
    """(keep..., model, score, pred): every row scored by every family of a table of models. ``sent``: its
    ``sent_models``, if they are loaded."""
    sent = sent_models(table) if sent is None else sent
    large = [r.family for r in table.select("family").distinct().orderBy("family").collect() if (r.family,) not in sent]
    parts = [score_table(rows, sent, features, keep)] if sent else []
    if large:
        parts.append(_score_in_chunks(rows, table.where(F.col("family").isin(large)), list(features), list(keep)))
    return functools.reduce(DataFrame.unionByName, parts) if parts else score_table(rows, {}, features, keep)


def _score_in_chunks(rows: DataFrame, table: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """``score_table`` by models of any size. A task takes a slice of the rows and every so-manieth chunk, one at
    a time; the tasks' sums are added up by the row's number in its slice, whatever rows there are twice."""
    kinds, xs = dict(rows.dtypes), [f"x{i}" for i in range(len(features))]
    rows = materialize(rows.select(*keep, *[F.col(c).cast("double").alias(x) for c, x in zip(features, xs, strict=True)]))
    count, session = rows.count(), rows.sparkSession
    slices, shares = max(1, -(-count // SLICE_ROWS)), max(1, min(session.sparkContext.defaultParallelism, table.count()))
    trees = table.select("family", "chunk", F.octet_length("model").alias("size"))
    parts = {}  # the chunks of the models, largest first, go to the share that has least
    load = [0] * shares
    for r in trees.orderBy(F.desc("size"), "family", "chunk").collect():  # a row a chunk
        parts[r.family, r.chunk] = to = load.index(min(load))
        load[to] += r["size"]
    dealt = session.createDataFrame([(*k, v) for k, v in parts.items()], "family string, chunk int, share int")
    asked = rows.withColumn("slice", F.pmod(F.xxhash64(*keep, *xs), F.lit(slices)).cast("int")) \
        .withColumn("share", F.explode(F.array(*[F.lit(i) for i in range(shares)])))
    model = table.join(F.broadcast(dealt), ["family", "chunk"]).select(
        "family", "chunk", "model", "share", F.explode(F.array(*[F.lit(i) for i in range(slices)])).alias("slice"))
    both = asked.withColumns({"family": F.lit(None).cast("string"), "chunk": F.lit(-1), "model": F.lit(None).cast("binary")}) \
        .unionByName(model, allowMissingColumns=True).withColumn("_part", F.col("slice") * shares + F.col("share"))
    both = both.repartitionById(slices * shares, F.col("_part")).sortWithinPartitions("chunk", "family", *keep, *xs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, x, sums, counts, own, share = [], None, {}, {}, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            share = batch.column("share")[0].as_py()
            is_row = batch.column("chunk").to_numpy() < 0
            n = int(is_row.sum())  # rows come first
            if n:
                held.append(batch.slice(0, n))
            for i in range(n, batch.num_rows):
                if x is None:
                    own = pa.Table.from_batches(held) if held else None
                    x = np.column_stack([own.column(c).to_numpy() for c in xs]) if held else np.zeros((0, len(xs)))
                    held = []
                trees = Trees.from_bytes(batch.column("model")[i].as_py())
                family = batch.column("family")[i].as_py()
                sums[family] = sums.get(family, 0.0) + trees.decision(x)
                counts[family] = counts.get(family, 0) + len(trees.roots)
        for family, d in sorted(sums.items()):
            for a in range(0, len(d), whole.BLOCK):
                part = own.slice(a, whole.BLOCK).combine_chunks()
                m = part.num_rows
                yield from pa.table([*(part.column(c) for c in keep), part.column("slice"), pa.array(range(a, a + m), pa.int64()),
                                     pa.array([family] * m), pa.array(np.full(m, share, np.int32)), pa.array(d[a:a + m]),
                                     pa.array(np.full(m, counts[family], np.int64))],
                                    names=[*keep, "slice", "place", "model", "share", "d", "trees"]).to_batches()

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in keep), "slice int, place long, model string, share int, d double, trees long"])
    sums = both.mapInArrow(run, schema).groupBy("slice", "place", "model").agg(
        *[F.first(c).alias(c) for c in keep], F.sum("trees").alias("trees"),
        F.aggregate(F.array_sort(F.collect_list(F.struct("share", "d"))), F.lit(0.0), lambda t, r: t + r["d"]).alias("d"))
    boosted = F.col("model").isin("XGBoost", "AdaBoost")
    score = F.when(boosted, 1 / (1 + F.exp(-F.col("d")))).when(
        F.col("model") == "RandomForest", F.col("d") / F.greatest("trees", F.lit(1))).otherwise(F.col("d"))
    pred = F.when(boosted, F.col("d") > 0).otherwise(score > 0.5).cast("int")
    return materialize(sums.select(*keep, "model", score.alias("score"), pred.alias("pred")))


def importances(table: DataFrame, family: str, count: int) -> np.ndarray:
    """``Trees.importances`` of a family of a table of models; what is collected is one row for each tree."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for chunk, model in zip(part["chunk"], part["model"], strict=True):
                gains = Trees.from_bytes(model).gains(count)
                yield pd.DataFrame({"tree": chunk + np.arange(len(gains)), "gains": list(gains)})

    found = table.where(F.col("family") == family).select("chunk", "model").mapInPandas(run, "tree long, gains array<double>")
    rows = sorted(found.collect(), key=lambda r: r.tree)
    return mean_share(np.array([r.gains for r in rows]).reshape(-1, count))


# --- cross-validation: trees in tasks of their own, the other families as jobs over all rows --

def score_folds(rows: DataFrame, models: DataFrame, features: Sequence[str], per_fold: int,
                n_folds: int, id_col: str = "tx_id", label: str = "label") -> DataFrame:
    """(model, candidate, cv, set, id, label, score, pred): every row of ``rows`` (cv, set, id,
    label, features) scored by all trees of its ``cv``.

    ``models`` has the fitted chunks by (family, candidate, cv). A row moves once for its cv, whatever
    the number of candidates; a task scores a hash slice of at most about ``SCORE_ROWS`` rows of one cv, and
    decodes the models one after the other."""
    features, n = list(features), max(1, math.ceil(per_fold / SCORE_ROWS))
    keys = ["cv", "slice"]
    kinds = dict(rows.dtypes)
    schema = (f"model string, candidate string, cv int, set string, {id_col} {kinds[id_col]}, "
              f"{label} {kinds[label]}, score double, pred int")
    out_cols = ["model", "candidate", "cv", "set", id_col, label, "score", "pred"]

    def run(key: tuple, parts: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame(columns=out_cols)]
        x = own[features].to_numpy(float)
        for (family, candidate), chunks in parts.groupby(["family", "candidate"]) if len(own) else ():
            trees = join_trees([Trees.from_bytes(b) for b in chunks.sort_values("chunk")["model"]])
            scored = own[["set", id_col, label]].copy()
            scored["model"], scored["candidate"], scored["cv"] = family, candidate, int(key[0])
            scored["score"], scored["pred"] = probability(family, trees, x)
            out.append(scored[out_cols])
        return pd.concat(out[1:] or out)

    tasks = max(1, min(n_folds * n, MAX_TASKS))
    asked = rows.select("cv", "set", id_col, label, *features,
                        F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias("slice")).repartition(tasks, *keys)
    fitted = models.select("family", "candidate", "cv", "chunk", "model",
                           F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("slice")).repartition(tasks, *keys)
    return fitted.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(run, schema)


def score_whole(train: DataFrame | None, rows: DataFrame, features: Sequence[str],
                candidates: Sequence[tuple[str, str, dict]], id_col: str = "tx_id", label: str = "label") -> DataFrame:
    """``score_folds`` of larger fits: every candidate fitted on all rows of ``train`` (cv, id, label, features)
    of a cv, in tasks that lead the rows of ``rows`` along and store no model. Without ``train`` the fits are
    on the rows of the set Training, which are all there once."""
    features, d, session = list(features), len(features), rows.sparkSession
    kinds = dict(rows.dtypes)
    kept = {"set": "set string", id_col: f"id {kinds[id_col]}", label: f"label {kinds[label]}", "_kind": "kind int"}
    cols, names = ["cv", *features, "set", id_col, label], ["set", "id", "label"]
    alike = train is None
    if alike:
        asked = rows.select(*cols, F.when(F.col("set") == "Validation", whole.ASKED).otherwise(_kind(label)).alias("_kind"))
        fitted, cuts = None, growth.cut_table(rows.where(F.col("set") == "Training"), features, "cv")
    else:
        asked, cuts = rows.select(*cols, F.lit(whole.ASKED).alias("_kind")), growth.cut_table(train, features, "cv")
        fitted = train.select("cv", *features, F.lit(None).cast("string").alias("set"),
                              F.lit(None).cast(kinds[id_col]).alias(id_col), F.col("label").cast(kinds[label]).alias(label),
                              _kind("label").alias("_kind"))
    fits = sorted(cuts)
    asked = asked.where(F.col("cv").isin(fits))
    binned = growth.bin_rows(asked if fitted is None else fitted.unionByName(asked), features, cuts, "cv", kept)
    tasks = _shared([j for f, n, p in candidates for j in _jobs(f, TUNED[f] | p, n)], len(fits),
                    session.sparkContext.defaultParallelism)
    out_cols = ["model", "candidate", "cv", "set", id_col, label, "score", "pred"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _spooled(batches, d, fits, tasks, names)
        if found is None:
            return
        g, jobs, spooled = found
        at = 0 if alike else spooled.count(whole.POSITIVE, whole.OTHER)
        own = pa.concat_tables(spooled.kept).slice(at)
        for job in jobs:
            if job.family == "AdaBoost":
                stumps = whole.boost_stumps(spooled, job.params["n_estimators"], job.params["learning_rate"])
                alphas = np.array([x[-1] for x in stumps])
                decision = whole.stump_scores(spooled, stumps, alphas / (alphas.sum() or 1.0))
            else:
                trees, decision = job.fitted(spooled, cuts[g], True)
                for _ in trees:
                    pass
            for a in range(0, own.num_rows, whole.BLOCK):
                part = own.slice(a, whole.BLOCK)
                m = part.num_rows
                score, pred = of_decision(job.family, np.array(decision[at + a:at + a + m]), job.trees or 1)
                yield from pa.table([pa.array([job.family] * m), pa.array([job.name] * m), pa.array(np.full(m, g, np.int32)),
                                     *(part.column(c) for c in names), pa.array(score), pa.array(pred)],
                                    names=out_cols).to_batches()

    schema = (f"model string, candidate string, cv int, set string, {id_col} {kinds[id_col]}, {label} {kinds[label]}, "
              "score double, pred int")
    return materialize(_dealt(binned, fits, tasks, ["bins", "id", "set"]).mapInArrow(run, schema))


def neighbour_votes(train: DataFrame, rows: DataFrame, ks: dict[str, int], id_col: str = "tx_id",
                    label: str = "label") -> DataFrame:
    """Predictions by the k nearest rows (L1) of ``train`` (cv, id, label, vec), for the candidates
    ``ks`` (name: k); ``rows``: cv, set, id, label, vec.

    Held-out rows go through the exact join, once for the largest k. A row that is itself a
    reference has neighbours at distance zero, which share all weight: the first k references,
    in id order, of equal vectors, so these rows only need the counts of their vector."""
    most = max(ks.values())
    held, known = (rows.where(F.col("set") == s) for s in ("Validation", "Training"))
    near = materialize(knn_join(held.select("cv", F.col(id_col).alias("id"), "vec"), train, most, metric="l1",
                                group="cv").withColumn("cv", F.col("cv").cast("int")))
    refs = train.select("cv", "id", "label")
    first = Window.partitionBy("cv", "vec").orderBy("id")
    # a filter on the rank lets every task drop all but the first rows of a vector before the exchange
    same = train.select("cv", "vec", "id", "label").withColumn("rank", F.row_number().over(first)) \
        .where(F.col("rank") <= most)
    same = materialize(same.groupBy("cv", "vec").agg(*[F.avg(F.when(
        F.col("rank") <= k, (F.col("label") == 1).cast("double"))).alias(f"k{k}") for k in sorted(set(ks.values()))]))
    cols = ["cv", "set", F.col(id_col), F.col(label), "score"]
    out = None
    for name, k in ks.items():
        votes = knn_classify(near.where(F.col("rank") <= k), refs, group="cv").drop("pred") \
            .withColumnRenamed("q_id", id_col).join(held, ["cv", id_col]).select(*cols)
        votes = votes.unionByName(known.join(same, ["cv", "vec"]).withColumn("score", F.col(f"k{k}")).select(*cols))
        votes = votes.withColumns({"model": F.lit("KNN"), "candidate": F.lit(name)})
        out = votes if out is None else out.unionByName(votes)
    return out.withColumn("pred", (F.col("score") > 0.5).cast("int"))


def cross_validated(folds: DataFrame, features: Sequence[str], candidates: Sequence[tuple[str, str, dict]],
                    n_folds: int, ratio: float | None = None, label: str = "label", id_col: str = "tx_id",
                    training: bool = True, fit_rows: int | None = None) -> DataFrame:
    """(model, candidate, cv, set, id, label, score, pred): every candidate (family, name,
    parameters) fitted on every fold's other rows, which are oversampled first if ``ratio`` is
    given, and its predictions for all held-out rows (set Validation) and, with
    ``training``, for all rows it was fitted on (set Training).

    ``folds`` is a table of any size with a column ``fold`` and an integer id. Oversampling, naive Bayes
    and nearest neighbours run as jobs over whole folds, grouped by the key ``cv``. The tree families
    are fitted on all rows of each fold's training part, unless a caller bounds them by ``fit_rows``."""
    features = list(features)
    by_family: dict[str, dict[str, dict]] = {}
    for family, name, p in candidates:
        by_family.setdefault(family, {})[name] = dict(p)
    base = folds.where(F.col(label).isNotNull()).select(
        id_col, F.col(label).cast("int").alias(label), F.col("fold").cast("int").alias("fold"),
        *[F.col(c).cast("double").alias(c) for c in features]).withColumn("vec", F.array(*features))
    every = F.sequence(F.lit(0), F.lit(n_folds - 1))
    others = F.explode(F.filter(every, lambda t: t != F.col("fold")))
    train = base.select(F.col(id_col).alias("id"), F.col(label).alias("label"), "vec", others.alias("cv"))
    if ratio:  # only the new rows are written; the others are copies of a table that there is
        new = smote(train, ratio=ratio, group="cv").where("is_synthetic").select("cv", "id", "label", "vec")
        train = train.select("cv", "id", "label", "vec").unionByName(materialize(new))
    train = train.select("cv", "id", "label", "vec", *[F.col("vec")[i].alias(c) for i, c in enumerate(features)])
    rows = base.select("*", F.explode(every).alias("cv")) if training else base.withColumn("cv", F.col("fold"))
    rows = rows.withColumn("set", F.when(F.col("cv") == F.col("fold"), "Validation").otherwise("Training"))
    out_cols = ["model", "candidate", "cv", "set", id_col, label, "score", "pred"]
    parts = []
    trees = [(f, n, p) for f, own in by_family.items() if f in FAMILIES for n, p in own.items()]
    if trees:
        sample = fit_sample(train, id_col="id", n=fit_rows, by=["cv"])
        if largest_fit(sample, by=["cv"]) > SMALL_ROWS:
            alike = training and not ratio and fit_rows is None
            parts.append(score_whole(None if alike else sample, rows, features, trees, id_col, label))
        else:
            sample = materialize(sample)
            cells = growth.cell_table(sample, features, "cv")
            fitted = [fit_table(sample, features, [f], {f: p}, id_col="id", by=["cv"], cells=cells)
                      .withColumn("candidate", F.lit(n)) for f, n, p in trees]
            fitted = materialize(functools.reduce(DataFrame.unionByName, fitted))
            count = base.count()
            parts.append(score_folds(rows, fitted, features, count if training else math.ceil(count / n_folds),
                                     n_folds, id_col, label))
    if bayes := by_family.get("NaiveBayes"):
        smoothing = {n: p.get("var_smoothing", VAR_SMOOTHING) for n, p in bayes.items()}
        params = gnb_fit_grouped(train, features, "cv", smoothing)
        parts.append(gnb_transform_grouped(rows, params, features, "cv").withColumn("model", F.lit("NaiveBayes")))
    if near := by_family.get("KNN"):
        parts.append(neighbour_votes(train, rows, {n: p.get("n_neighbors", NEIGHBOURS) for n, p in near.items()},
                                     id_col, label))
    return functools.reduce(DataFrame.unionByName, [p.select(*out_cols) for p in parts])
