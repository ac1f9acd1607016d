"""Exact interventional Shapley values of tree ensembles.

A leaf is a box: for each feature on its path, the interval that leads there. With a record x
and a background row z, a coalition takes some features from x and the others from z. A leaf of
value v counts only if no path feature is missed by both; then, with p features that x alone
passes and q that z alone passes, each of the first has the Shapley value v (p-1)! q! / (p+q)!
and each of the others -v p! (q-1)! / (p+q)!. Values add up over leaves and average over the
background, so the cost is records x leaves, whatever the number of coalitions.

Passing is a bit mask for each leaf. The masks of the background are counted once, and in a
batch every different mask of the records is worked out once. The values explain the ensemble's
decision (the weighted sum of its leaves); they sum to the record's decision less the
background's mean. Missing values go right, as in scoring. Rows are mapped without a shuffle.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.operators.explain import background_matrix

#: Bytes of the boxes sent to the tasks, and features of one leaf's path.
BOX_BYTES, MOST_FEATURES = 256 << 20, 62


class Leaf(NamedTuple):
    value: float
    features: np.ndarray
    low: np.ndarray    # a value passes if it is above this ...
    high: np.ndarray   # ... and at most this
    masks: np.ndarray  # of the background rows, each once
    share: np.ndarray  # of the background rows that have it


def _passes(x: np.ndarray, leaf_features, low, high) -> np.ndarray:
    """Bit mask by column of ``x`` (features x rows): bit j is set if path feature j is passed."""
    own = x[leaf_features]
    inside = (own <= high[:, None]) & ~(own <= low[:, None])
    return (inside << np.arange(len(leaf_features))[:, None]).sum(axis=0)


def _by_feature(x: np.ndarray) -> np.ndarray:
    """Features x rows; a missing value is above every cut."""
    return np.where(np.isnan(x), np.inf, x).T.copy()


def leaf_boxes(model, background: np.ndarray) -> list[Leaf]:
    """The leaves that are not zero, with the masks of the background."""
    z = _by_feature(background)
    feature, cut, left, right = (a.tolist() for a in (model.feature, model.cut, model.left, model.right))
    out = []
    for root, weight in zip(model.roots.tolist(), model.weight.tolist(), strict=True):
        todo: list[tuple[int, dict]] = [(root, {})]
        while todo:
            node, box = todo.pop()
            f = feature[node]
            if f >= 0:
                low, high = box.get(f, (-np.inf, np.inf))
                todo.append((left[node], {**box, f: (low, min(high, cut[node]))}))
                todo.append((right[node], {**box, f: (max(low, cut[node]), high)}))
                continue
            value = weight * float(model.value[node])
            if value == 0 or not box:
                continue
            if len(box) > MOST_FEATURES:
                raise ValueError(f"a path with over {MOST_FEATURES} features")
            fs = np.array(list(box), np.int64)
            lows, highs = (np.array([b[i] for b in box.values()]) for i in (0, 1))
            masks, n = np.unique(_passes(z, fs, lows, highs), return_counts=True)
            out.append(Leaf(value, fs, lows, highs, masks, n / len(background)))
    return out


def _weights(most: int) -> tuple[np.ndarray, np.ndarray]:
    """By (p, q): the share of a feature that the record alone passes, or the background alone."""
    gain, loss = np.zeros((most + 1, most + 1)), np.zeros((most + 1, most + 1))
    fact = [math.factorial(i) for i in range(2 * most + 1)]
    for p in range(most + 1):
        for q in range(most + 1):
            if p:
                gain[p, q] = fact[p - 1] * fact[q] / fact[p + q]
            if q:
                loss[p, q] = fact[p] * fact[q - 1] / fact[p + q]
    return gain, loss


def decision_shapley(x: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Shapley values (rows x features) of the ensemble's decision."""
    rows = _by_feature(x)
    phi = np.zeros(rows.shape)
    gain, loss = _weights(max((len(leaf.features) for leaf in leaves), default=0))
    for value, features, low, high, masks, share in leaves:
        own, of = np.unique(_passes(rows, features, low, high), return_inverse=True)
        mine, theirs = own[:, None] & ~masks, masks & ~own[:, None]
        p, q = np.bitwise_count(mine), np.bitwise_count(theirs)
        weight = np.where((own[:, None] | masks) == (1 << len(features)) - 1, value * share, 0.0)
        plus, minus = weight * gain[p, q], weight * loss[p, q]
        bits = np.arange(len(features))[:, None, None]
        table = ((mine >> bits & 1) * plus - (theirs >> bits & 1) * minus).sum(axis=2)
        phi[features] += table[:, of]
    return phi.T


def tree_shapley(rows: DataFrame, background: DataFrame | np.ndarray, features: Sequence[str], model,
                 id_col: str = "tx_id") -> DataFrame:
    """(id, feature, phi) of every row of ``rows`` for a fitted ensemble."""
    feats = list(features)
    bg = background if isinstance(background, np.ndarray) else background_matrix(background, feats)
    data = pickle.dumps(leaf_boxes(model, bg))
    if len(data) > BOX_BYTES:
        raise ValueError(f"the leaves take over {BOX_BYTES} bytes; explain fewer trees at a time")
    sent = rows.sparkSession.sparkContext.broadcast(data)
    names = pa.array(feats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves = pickle.loads(sent.value)
        for part in batches:
            x = np.stack([part.column(f).to_numpy(zero_copy_only=False).astype(float) for f in feats], axis=1)
            n, d = x.shape
            if not n:
                continue
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col).take(pa.array(np.repeat(np.arange(n), d))),
                 names.take(pa.array(np.tile(np.arange(d), n))), pa.array(decision_shapley(x, leaves).ravel())],
                [id_col, "feature", "phi"])

    kind = dict(rows.dtypes)[id_col]
    cells = rows.select(id_col, *[F.col(f).cast("double").alias(f) for f in feats if f != id_col])
    return cells.mapInArrow(run, f"{id_col} {kind}, feature string, phi double")


def top_of_record(phi: DataFrame, n: int, id_col: str = "tx_id") -> DataFrame:
    """The ``n`` largest values of each record with their ranks."""
    w = Window.partitionBy(id_col).orderBy(F.abs("phi").desc(), "feature")  # one record's features
    return phi.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)
