"""Model explanation as DataFrame jobs.

* permutation importance: repeat r gives each row a donor by a keyed permutation of the row
  numbers that is computed, not sorted (``keyed_permutation``). One equi-join by number brings the
  donors' values; a map scores every single-column variant and adds up the hits in the task,
* Shapley values (interventional, against a background sample): a row-wise map without a
  shuffle. A batch of rows, all coalitions of the chosen method and the background
  form the inputs of one vectorised call of the model; v(S) is the mean over the
  background, and the values are a fixed matrix times v,
* global summary: mean |phi| per feature.

Both take a *predictor* ``f(matrix)`` (any fitted model: one row of the matrix is one input), which
runs in Arrow batches: classes for permutation importance, scores for Shapley values.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.functions.hashing import DEFAULT_SEED
from txscore.session import materialize, shuffle_partitions

Predictor = Callable[[np.ndarray], np.ndarray]

N_REPEATS = 10          # fixed value: permutation repeats
TOP_N = 20              # fixed value: features shown in importance reports
BACKGROUND_BYTES = 64 << 20   # size bound of the background matrix sent to the tasks
INPUT_CELLS = 1 << 22         # cells of one call of the predictor
PERMUTATION_ROUNDS = 4        # of the Feistel network
PRIME = 2147483647


def _mixed(x: np.ndarray, key: int, size: int) -> np.ndarray:
    """A number below ``size`` for each x: a congruential step, a square and another step."""
    u = (x * 48271 + key) % PRIME
    return u * u % PRIME * 69621 % PRIME % size


def keyed_permutation(at: np.ndarray, n: int, repeat: int, seed: int = DEFAULT_SEED) -> np.ndarray:
    """Images of the numbers ``at`` (0 to n - 1) under a permutation of all of them: a Feistel network on
    the cells of a grid of at least n cells, walked on while it is outside the n."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    b = max(1, -(-n // a))
    out = np.array(at, np.int64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = np.divmod(out[todo], b)
        for i in range(PERMUTATION_ROUNDS):
            key = (seed * 1000003 + repeat * 7919 + i * 104729) % PRIME
            left = (left + _mixed(right, key, a)) % a
            right = (right + _mixed(left, key + 1, b)) % b
        out[todo] = left * b + right
        todo = todo[out[todo] >= n]
    return out


def numbered_rows(df: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """(rows with ``_pos`` 0 to n - 1, n) without a sort: ids that are these numbers stand for
    themselves, other rows are numbered by part of the written table and place in it."""
    df = materialize(df)
    kind = dict(df.dtypes)[id_col]
    if kind in ("bigint", "int", "smallint", "tinyint"):
        n, low, high, each = df.agg(F.count(F.lit(1)), F.min(id_col), F.max(id_col), F.count_distinct(id_col)).first()
        if n == 0 or (low, high, each) == (0, n - 1, n):
            return df.withColumn("_pos", F.col(id_col).cast("long")), n
    df = materialize(df.withColumn("_mark", F.monotonically_increasing_id()))
    part = F.shiftright("_mark", 33)
    sizes = df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row a task
    starts = dict(zip([r.part for r in sizes], np.cumsum([0, *(r.n for r in sizes)]).tolist(), strict=False))
    offset = F.create_map(*[F.lit(x) for p, s in starts.items() for x in (p, s)]) if starts else F.lit(None)
    place = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumn("_pos", (offset[part] + place).cast("long")).drop("_mark"), sum(r.n for r in sizes)


def permutation_importance(df: DataFrame, features: Sequence[str], predict: Predictor,
                           id_col: str = "tx_id", label: str = "label",
                           n_repeats: int = N_REPEATS, seed: int = DEFAULT_SEED) -> DataFrame:
    """(feature, importance_mean, importance_std): the accuracy that ``predict`` (classes of a feature
    matrix) loses when one column is permuted, over ``n_repeats`` seeded permutations.

    In repeat r every row takes its donor's value of one feature at a time. Missing values are NaN."""
    feats = list(features)
    rows = df.select(id_col, F.col(label).cast("long").alias("_y"),
                     *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(feats)])
    base, n = numbered_rows(rows, id_col)
    xs = [f"_x{i}" for i in range(len(feats))]
    base = base.select("_pos", "_y", *xs)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            at = part.column("_pos").to_numpy()
            for r in range(n_repeats):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keyed_permutation(at, n, r, seed)), pa.repeat(pa.scalar(r, pa.int32()), len(at)),
                     *[part.column(c) for c in ("_y", *xs)]], ["_donor", "repeat", "_y", *xs])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list[int]] = {}

        def add(key, ok):
            t = total.setdefault(key, [0, 0])
            t[0] += int(ok.sum())
            t[1] += len(ok)

        for part in batches:
            if not part.num_rows:
                continue
            x, d = (np.stack([part.column(f"{p}{i}").to_numpy(zero_copy_only=False).astype(float)
                              for i in range(len(feats))], axis=1) for p in ("_x", "_d"))
            y, repeat = part.column("_y").to_numpy(), part.column("repeat").to_numpy()
            first, own = repeat == 0, predict(x)
            if first.any():
                add((-1, 0), own[first] == y[first])
            for i in range(len(feats)):
                other = np.flatnonzero(~((x[:, i] == d[:, i]) | (np.isnan(x[:, i]) & np.isnan(d[:, i]))))
                found = own.copy()  # a donor of the same value changes nothing
                if len(other):
                    z = x[other]
                    z[:, i] = d[other, i]
                    found[other] = predict(z)
                ok = found == y
                for r in np.unique(repeat).tolist():
                    add((i, r), ok[repeat == r])
        keys = np.array(list(total), np.int64).reshape(-1, 2)
        sums = np.array(list(total.values()), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*keys.T, *sums.T)], ["f", "repeat", "hit", "n"])

    kind = ", ".join(f"{c} double" for c in xs)
    asked = base.where("_y is not null").mapInArrow(ask, f"_donor long, repeat int, _y long, {kind}")
    donors = base.select(F.col("_pos").alias("_donor"), *[F.col(c).alias(f"_d{i}") for i, c in enumerate(xs)])
    # dealt out, as a small table would be one part, and a variant may be thousands of trees
    tasks = max(shuffle_partitions(df.sparkSession), 2 * df.sparkSession.sparkContext.defaultParallelism)
    asked, donors = (t.repartition(tasks, "_donor") for t in (asked, donors))
    # one row for each task, feature and repeat comes out
    scored = asked.join(donors, "_donor").mapInArrow(hits, "f long, repeat long, hit long, n long")
    acc = scored.groupBy("f", "repeat").agg((F.sum("hit") / F.sum("n")).alias("acc"))
    # one row for each feature and repeat, and one for the rows as they are
    base_acc = F.max(F.when(F.col("f") < 0, F.col("acc"))).over(Window.partitionBy(F.lit(0)))
    drop = acc.withColumn("drop", base_acc - F.col("acc")).where("f >= 0")
    names = F.get(F.array(*[F.lit(f) for f in feats]), F.col("f").cast("int"))
    return drop.groupBy("f").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")) \
        .select(names.alias("feature"), "importance_mean", "importance_std")


def sampled_permutations(d: int, n: int, seed: int = DEFAULT_SEED) -> list[list[int]]:
    """``n`` seeded feature orders (md5 ranks), reproducible in any engine."""
    perms = []
    for m in range(n):
        keys = [(hashlib.md5(f"{m}:{i}:{seed}".encode()).hexdigest(), i) for i in range(d)]
        perms.append([i for _, i in sorted(keys)])
    return perms


def exact_coalitions(d: int) -> tuple[np.ndarray, np.ndarray]:
    """All 2^d coalitions (masks by row) and the matrix W with phi = W v: every S without i
    has the weight |S|!(d-|S|-1)!/d! in v(S+i) - v(S)."""
    masks = (np.arange(2 ** d)[:, None] >> np.arange(d)) & 1 == 1
    weight = np.array([math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d) for s in range(d)])
    size, w = masks.sum(1), np.zeros((d, 2 ** d))
    for i in range(d):
        without = np.flatnonzero(~masks[:, i])
        w[i, without] -= weight[size[without]]
        w[i, without + (1 << i)] += weight[size[without]]
    return masks, w


def sampled_coalitions(d: int, permutations: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The coalitions before and after each feature in the given orders, each once, and W: the
    estimator of Strumbelj & Kononenko (the efficiency property holds exactly)."""
    place: dict[bytes, int] = {}
    masks, gains = [], []

    def number(mask: np.ndarray) -> int:
        key = mask.tobytes()
        if key not in place:
            place[key] = len(masks)
            masks.append(mask.copy())
        return place[key]

    for perm in permutations:
        mask = np.zeros(d, bool)
        before = number(mask)
        for i in perm:
            mask[i] = True
            after = number(mask)
            gains.append((i, before, after))
            before = after
    w = np.zeros((d, len(masks)))
    for i, before, after in gains:
        w[i, before] -= 1 / len(permutations)
        w[i, after] += 1 / len(permutations)
    return np.array(masks), w


def budgeted_coalitions(d: int, max_evals: int, seed: int = DEFAULT_SEED) -> tuple[np.ndarray, np.ndarray]:
    """Sampled coalitions of as many whole orders as ``max_evals`` evaluations allow: an order
    needs d - 1 coalitions besides the empty and the full one. One order is the least."""
    orders = max(1, (max_evals - 2) // max(1, d - 1))
    return sampled_coalitions(d, sampled_permutations(d, orders, seed))


def background_matrix(background: DataFrame, features: Sequence[str]) -> np.ndarray:
    """The background rows as a matrix (missing values NaN); its size is checked first."""
    n = background.count()
    if n * len(features) * 8 > BACKGROUND_BYTES:
        raise ValueError(f"a background of {n} rows is over {BACKGROUND_BYTES} bytes; take a sample of it")
    rows = background.select(*[F.col(f).cast("double").alias(f) for f in features]).toPandas()
    return rows.to_numpy(float)


def coalition_values(x: np.ndarray, background: np.ndarray, masks: np.ndarray,
                     predict: Predictor) -> np.ndarray:
    """v(S) of every row (rows x coalitions): the mean of ``predict`` with the row's values on S
    and the background's elsewhere."""
    out = np.empty((len(x), len(masks)))
    rows = max(1, INPUT_CELLS // max(1, background.size))
    pairs = np.indices(out.shape).reshape(2, -1)
    for i in range(0, pairs.shape[1], rows):
        r, m = pairs[:, i:i + rows]
        z = np.where(masks[m][:, None, :], x[r][:, None, :], background[None])
        out[r, m] = predict(z.reshape(-1, x.shape[1])).reshape(len(r), -1).mean(1)
    return out


def shapley_values(rows: DataFrame, background: DataFrame | np.ndarray, features: Sequence[str],
                   predict: Predictor, coalitions: tuple[np.ndarray, np.ndarray],
                   id_col: str = "tx_id") -> DataFrame:
    """(id, feature, phi): interventional Shapley values of ``predict`` for every row.

    ``coalitions`` is the method, chosen by the caller: ``exact_coalitions(d)``,
    ``sampled_coalitions(d, orders)`` or ``budgeted_coalitions(d, evaluations)``."""
    feats = list(features)
    bg = background if isinstance(background, np.ndarray) else background_matrix(background, feats)
    masks, weights = coalitions

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            phi = coalition_values(part[feats].to_numpy(float), bg, masks, predict) @ weights.T
            yield pd.DataFrame({id_col: np.repeat(part[id_col].to_numpy(), len(feats)),
                                "feature": feats * len(part), "phi": phi.ravel()})

    kind = dict(rows.dtypes)[id_col]
    return rows.select(id_col, *[F.col(f).cast("double").alias(f) for f in feats]).mapInPandas(
        run, f"{id_col} {kind}, feature string, phi double")


def shapley_exact(rows: DataFrame, background: DataFrame | np.ndarray, features: Sequence[str],
                  predict: Predictor, id_col: str = "tx_id") -> DataFrame:
    """Shapley values over all 2^d coalitions."""
    return shapley_values(rows, background, features, predict, exact_coalitions(len(features)), id_col)


def shapley_summary(phi: DataFrame) -> DataFrame:
    """Global importance: mean |phi| per feature."""
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))


def top_importances(imp: DataFrame, value: str, n: int = TOP_N) -> DataFrame:
    """Top-n rows by ``value`` descending (distributed take-ordered)."""
    return imp.orderBy(F.col(value).desc(), F.col("feature")).limit(n)
