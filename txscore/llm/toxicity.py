"""Toxicity scores from a counterfactual-regularised linear classifier.

Features of a text: its different words (letters, lower case) and word beginnings of a few
lengths, present or absent. Labelled sentences that name a group are rewritten, once with
another group's term and once with a word that names none; the fit minimises

    logistic loss + l1 * sum(w) + swap_penalty * mean((score(text) - score(rewritten text))**2)

over the scores before the sigmoid, so that a mere mention of a group moves no score:
identity terms that happen to go with the label in the sample get no weight of their own.
Both classes weigh the same in the loss, and weights are not negative: no amount of
harmless words excuses an insult, whatever the length of the text. Where the sample's classes
lie apart, the intercept is moved to the middle between them, so that one insult is enough.

The fit uses at most ``max_fit`` labelled rows (a documented bound; picked by a hash of
the id) and at most ``max_features`` features that occur in ``min_docs`` or more of them and
whose link to the label is the most significant. Feature counts are a Spark aggregate;
the bounded sample's rows come to the driver as feature numbers. The fitted weights (at
most ``max_features``) go to the tasks, which score every whole text.

Null text counts as empty. A text without known features has the score of the intercept.
Rows with a null label or id aren't learned from; several labels of one id count as their
largest. Without labelled rows the score is 0.5 for all rows, without one of the classes the
smoothed share of the other. Repeated rows are scored each. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import require, slices
from txscore.session import materialize

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
FOLDS = 5
MAX_FIT = 20_000
MAX_FEATURES = 4096
MIN_DOCS = 5
L1 = 2e-5
SWAP_PENALTY = 1.0
ROUNDS = 400
#: Expected number of features taken up that have nothing to do with the label.
CHANCE = 5.0

#: Share of a class's rows that may lie beyond its edge when the middle is sought.
EDGE = 0.005

#: Stands for any term in a sentence that is to name no group.
NEUTRAL = "people"

#: Terms that stand for one another in a rewritten sentence, by kind of group.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "indigenous", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "transgender"),
    ("man", "woman"), ("men", "women"), ("boy", "girl"), ("male", "female"),
    ("young", "old"), ("disabled", "deaf", "blind", "autistic"),
    ("immigrant", "refugee", "foreigner"), ("immigrants", "refugees", "foreigners"),
    ("mexican", "chinese", "african", "american", "european", "indian"),
    ("frau", "mann"), ("frauen", "männer"), ("christen", "muslime", "juden"),
    ("femme", "homme"), ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"),
)


def features(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    out = set(words)
    for n in BEGINNINGS:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


def swapper(groups: tuple[tuple[str, ...], ...]):
    """Function that gives the text with each identity term replaced by the next one of its
    group, and with each replaced by a neutral word (nothing, if the text has no term)."""
    follow = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    pattern = re.compile(r"(?<!\w)(" + "|".join(sorted(map(re.escape, follow), key=len, reverse=True))
                         + r")(?!\w)")

    def swap(text: str | None) -> list[str]:
        text = (text or "").lower()
        if not pattern.search(text):
            return []
        return [pattern.sub(lambda m: follow[m[1]], text), pattern.sub(NEUTRAL, text)]

    return swap


@dataclass
class Model:
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.whole = {w: x for w, x in self.weights.items() if not w.endswith("*")}
        self.start = [(n, {w[:-1]: x for w, x in self.weights.items() if w.endswith("*") and len(w) == n + 1})
                      for n in BEGINNINGS]

    def score(self, text: str | None) -> float:
        words = set(WORD.findall((text or "").lower()))
        total = self.bias + sum(self.whole[w] for w in sorted(self.whole.keys() & words))
        for n, known in self.start:
            if known:
                found = known.keys() & {w[:n] for w in words if len(w) > n}
                total += sum(known[w] for w in sorted(found))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, total))))


def fit_weights(labels: np.ndarray, rows: np.ndarray, cols: np.ndarray, size: int,
                swap_rows: np.ndarray, swap_cols: np.ndarray, swap_change: np.ndarray, swaps: int,
                l1: float = L1, swap_penalty: float = SWAP_PENALTY,
                rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps.

    Text ``rows[i]`` has feature ``cols[i]``; rewriting text ``swap_rows[j]`` changes feature
    ``swap_cols[j]`` by ``swap_change[j]`` (1 or -1)."""
    n = len(labels)
    step = 1.0  # halved wherever a step is too long, and lengthened slowly
    w, bias, t = np.zeros(size), 0.0, 1.0
    v, c = w.copy(), bias
    weight = np.where(labels > 0, 0.5 / labels.sum(), 0.5 / (n - labels.sum()))

    def parts(w: np.ndarray, b: float) -> tuple[np.ndarray, np.ndarray]:
        z = b + np.bincount(rows, w[cols], n)
        gap = np.bincount(swap_rows, swap_change * w[swap_cols], max(swaps, 1))
        return z, gap

    def loss(w: np.ndarray, b: float) -> float:
        z, gap = parts(w, b)
        return float(weight @ (np.logaddexp(0, z) - labels * z) + swap_penalty * np.sum(gap ** 2) / max(swaps, 1))

    for _ in range(rounds):
        z, gap = parts(v, c)
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        grad = np.bincount(cols, ((p - labels) * weight)[rows], size)
        grad += 2 * swap_penalty / max(swaps, 1) * np.bincount(swap_cols, swap_change * gap[swap_rows], size)
        slope = float(weight @ (p - labels))
        here = float(weight @ (np.logaddexp(0, z) - labels * z) + swap_penalty * np.sum(gap ** 2) / max(swaps, 1))
        while True:
            new = v - step * grad
            new = np.maximum(new - step * l1, 0)
            new_bias = c - step * slope
            dw, db = new - v, new_bias - c
            bound = here + grad @ dw + slope * db + (dw @ dw + db * db) / (2 * step)
            if loss(new, new_bias) <= bound + 1e-12:
                break
            step /= 2
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_next * (new - w)
        c = new_bias + (t - 1) / t_next * (new_bias - bias)
        w, bias, t = new, new_bias, t_next
        step *= 1.1
    return bias, w


def _sets(rows: DataFrame, keep: dict[str, int] | None, groups) -> DataFrame:
    """label, features, and those of the rewritten texts; with ``keep`` the numbers of these
    features only."""
    kind = "string" if keep is None else "int"
    item = pa.string() if keep is None else pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        swap = swapper(groups)

        def chosen(text: str) -> list:
            found = features(text)
            return sorted(found if keep is None else (keep[f] for f in keep.keys() & found))

        for part in slices(batches, "text"):
            own, other = [], []
            for text in part.column("text").to_pylist():
                own.append(chosen(text))
                other.append([chosen(t) for t in swap(text)])
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array(own, pa.list_(item)), pa.array(other, pa.list_(pa.list_(item)))],
                ["label", "own", "other"])

    return rows.mapInArrow(run, f"label int, own array<{kind}>, other array<array<{kind}>>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", usable: Column | None = None, max_fit: int = MAX_FIT,
        max_features: int = MAX_FEATURES, min_docs: int = MIN_DOCS, l1: float = L1,
        swap_penalty: float = SWAP_PENALTY, groups=IDENTITY_TERMS, rounds: int = ROUNDS) -> Model:
    """Model from labelled rows; ``usable``: condition on ``labels`` for rows to learn from."""
    require(docs, id_col, text_col)
    require(labels, id_col, label_col)
    chosen = labels if usable is None else labels.where(usable)
    chosen = (chosen.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("fit_id"))
              .agg(F.max((F.col(label_col) > 0).cast("int")).alias("label"))
              .orderBy(F.xxhash64("fit_id"), "fit_id").limit(max_fit))  # at most max_fit rows
    texts = docs.select(F.col(id_col).cast("long").alias("fit_id"),
                        F.col(text_col).cast("string").alias("text"))
    # one text of each id, so that an id which many rows share fits no more than its one row
    order = F.when(F.col("text").isNotNull(), F.struct(F.xxhash64("text"), "text"))
    rows = materialize(texts.join(F.broadcast(chosen), "fit_id").groupBy("fit_id", "label")
                       .agg(F.min_by("text", order).alias("text")).select("label", "text"))
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = (positive + 1) / (n + 2)
    if not n or positive in (0, n):
        return Model(math.log(share / (1 - share)))
    rate = positive / n
    terms = [t for g in groups for t in g]
    counts = materialize(_sets(rows, None, groups).select("label", F.explode("own").alias("f")).groupBy("f")
                         .agg(F.count("*").alias("df"), F.sum("label").alias("dt"))
                         .where(F.col("df") >= min_docs))
    hit = F.col("dt") / F.col("df")
    surprise = F.col("df") * (hit * F.log(hit / rate) + F.when(hit < 1, (1 - hit) * F.log(
        (1 - hit) / (1 - rate))).otherwise(0.0))
    tested = counts.where((hit > rate)).withColumn("surprise", surprise)
    tries = counts.count()
    best = [r.f for r in tested.where(F.col("surprise") > math.log(max(tries, 1) / CHANCE))
            .orderBy(F.desc("surprise"), "f").limit(max_features).select("f").collect()]
    keep = {f: i for i, f in enumerate(dict.fromkeys(
        [*best, *terms, *(f for t in terms for f in sorted(features(t)))]))}
    table = _sets(rows, keep, groups).toPandas()
    y = table["label"].to_numpy(float)
    lengths = table["own"].map(len).to_numpy()
    at = np.repeat(np.arange(len(y)), lengths)
    cols = np.concatenate([np.asarray(x, np.int64) for x in table["own"]])
    swap_rows, swap_cols, change, swaps = [], [], [], 0
    for own, others in zip(table["own"], table["other"], strict=True):
        for other in others:
            before, after = set(own), set(other)
            for f in before ^ after:
                swap_rows.append(swaps)
                swap_cols.append(f)
                change.append(1.0 if f in after else -1.0)
            swaps += 1
    bias, w = fit_weights(y, at, cols, len(keep), np.array(swap_rows, np.int64),
                          np.array(swap_cols, np.int64), np.array(change), swaps, l1, swap_penalty, rounds)
    z = bias + np.bincount(at, w[cols], len(y))
    low, high = np.quantile(z[y == 0], 1 - EDGE), np.quantile(z[y > 0], EDGE)
    if high > low:
        bias -= (high + low) / 2
    return Model(float(bias), {f: float(w[i]) for f, i in keep.items() if w[i]})


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) of every row."""
    require(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"),
                 pa.array([model.score(t) for t in part.column("text").to_pylist()], pa.float64())],
                ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text_col: str = "text",
          **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``."""
    model = fit(docs, labels, usable=fold() != 0, text_col=text_col, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            scores = np.array([model.score(t) for t in part.column(text_col).to_pylist()])
            yield part.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out (the id's fold is 0 and taught nothing; true for null ids), score, predicted."""
    model = fit(docs, labels, usable=fold() != 0, **options)
    return score(docs, model).select(
        "doc_id", F.coalesce(fold() == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
