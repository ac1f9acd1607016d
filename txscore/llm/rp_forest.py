"""Near-duplicate vectors found with a forest of random-projection trees.

Each tree splits recursively: a level has a random direction, a node the median of its
sample's projections. A vector whose projection is within the spill margin of the median
goes to both children. Vectors that share a leaf in any tree are compared by exact cosine
in double precision; pairs at or above the threshold are links.

The trees are fitted on at most ``SAMPLE`` vectors (picked by a hash of the id), which bounds
what the driver gathers and what is sent to the tasks; every vector is indexed. The
spill margin is a multiple of the deviation that two vectors at the threshold have in a
projection, so a split parts hardly any such pair, and ``trees`` trees make up for it.

Equal vectors are one class and are compared once. A leaf with over ``leaf_limit`` classes
is cut into parts, and every pair of parts is a task of its own; products are computed in
blocks. A pair that shares several leaves is counted only in the smallest of them, so counts
need no table of pairs, and a leaf hands on only a spanning forest of its links.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
so do vectors of different lengths, and rows without an id. Rows that share an id are
one vertex. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.llm.bk_simhash import find, unite
from txscore.llm.common import require
from txscore.llm.components import components
from txscore.session import materialize

THRESHOLD = 0.95
TREES = 4
SPILL = 0.75
SEED = 11
#: Vectors that the trees are fitted on.
SAMPLE = 50_000
#: Sample vectors that a leaf has at least, and classes that it should have.
SAMPLE_LEAF, LEAF = 16, 256
#: Classes of a leaf that one task compares.
LEAF_LIMIT = 4096
#: Rows of a block of products; comparisons of leaf numbers at once.
BLOCK, COMPARED = 512, 1 << 22


class Trees:
    """Directions by tree and level, thresholds by tree, level and node."""

    def __init__(self, sample: np.ndarray, count: int, depth: int, margin: float, seed: int = SEED):
        rng = np.random.default_rng(seed)
        dims = sample.shape[1] if sample.size else 1
        self.margin, self.depth, self.count = margin, depth, count
        self.directions = rng.normal(size=(count, depth, dims))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.thresholds = [[np.zeros(1 << level) for level in range(depth)] for _ in range(count)]
        for t in range(count):
            node = np.zeros(len(sample), np.int64)
            for level in range(depth):
                p = sample @ self.directions[t, level]
                order = np.lexsort((p, node))
                size = np.bincount(node, minlength=1 << level)
                middle = np.cumsum(size) - size + size // 2
                full = size > 0
                self.thresholds[t][level][full] = p[order[middle[full]]]
                node = 2 * node + (p > self.thresholds[t][level][node])

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that a row of ``x`` (unit vectors) goes to, by row and leaf."""
        rows, leaves = [], []
        width = min(x.shape[1], self.directions.shape[2])
        for t in range(self.count):
            p = x[:, :width] @ self.directions[t, :, :width].T
            row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
            for level in range(self.depth):
                gap = p[row, level] - self.thresholds[t][level][node]
                left, right = gap <= self.margin, gap > -self.margin
                row, node = (np.concatenate([row[left], row[right]]),
                             np.concatenate([2 * node[left], 2 * node[right] + 1]))
            rows.append(row)
            leaves.append(np.int64(t) << 40 | node)
        row, leaf = np.concatenate(rows), np.concatenate(leaves)
        order = np.lexsort((leaf, row))
        return row[order], leaf[order]


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Unit vectors, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(v: Column) -> Column:
    """The vector has components, all finite, and not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def counted_here(leaf: int, sets: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which pairs (p[i], q[i]) have no common leaf below ``leaf``. Row j of ``sets`` holds the
    leaves of member j, padded with -1."""
    below = np.where(sets < leaf, sets, -1)
    kinds, kind = np.unique(below, axis=0, return_inverse=True)
    kinds = kinds[:, (kinds >= 0).any(axis=0)]
    width = kinds.shape[1]
    if not width:
        return np.ones(len(p), bool)
    pairs, place = np.unique(kind.ravel()[p] * len(kinds) + kind.ravel()[q], return_inverse=True)
    shared = np.zeros(len(pairs), bool)
    step = max(1, COMPARED // (width * width))
    for i in range(0, len(pairs), step):
        a, b = kinds[pairs[i:i + step] // len(kinds)], kinds[pairs[i:i + step] % len(kinds)]
        shared[i:i + step] = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any(axis=(1, 2))
    return ~shared[place.ravel()]


def compare(leaf: int, x: np.ndarray, part: np.ndarray, parts: tuple[int, int], rep: np.ndarray,
            times: np.ndarray, sets: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each member that count in this leaf, and its set within the leaf (the place of
    one member). Members of different parts are compared, or those of one if it is the same."""
    order = np.argsort(rep, kind="stable")
    x, part, rep, times, sets = x[order], part[order], rep[order], times[order], sets[order]
    links, parent = np.zeros(len(x), np.int64), np.arange(len(x))
    first = np.flatnonzero(part == parts[0])
    second = first if parts[0] == parts[1] else np.flatnonzero(part == parts[1])
    for i in range(0, len(first), BLOCK):
        own = first[i:i + BLOCK]
        for j in range(i if second is first else 0, len(second), 8 * BLOCK):
            other = second[j:j + 8 * BLOCK]
            p, q = np.nonzero(x[own] @ x[other].T >= threshold)
            p, q = own[p], other[q]
            good = (p < q if second is first else True) & (rep[p] != rep[q])
            p, q = p[good], q[good]
            unite(parent, p, q)
            here = counted_here(leaf, sets, p, q)
            links += np.bincount(p[here], times[q[here]], len(x)).astype(np.int64)
            links += np.bincount(q[here], times[p[here]], len(x)).astype(np.int64)
    back = np.argsort(order, kind="stable")
    return links[back], order[find(parent, np.arange(len(x)))][back]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, trees: int = TREES, spill: float = SPILL,
                    leaf_size: int = LEAF, leaf_limit: int = LEAF_LIMIT) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable, itself included), kept (it is that one)."""
    require(vectors, id_col, vector_col)
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.when(usable(v) & F.col(id_col).isNotNull(), v).alias("v"))
    rows = rows.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(1), "v")})
    classes = materialize(rows.where("v is not null").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("times"), F.first("v").alias("v"))
        .withColumn("dims", F.size("v")))
    n, dims = classes.agg(F.count("*"), F.max("dims")).first()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    picked = (classes.where(F.col("dims") == dims).orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE)
              .select("v").toArrow())  # at most SAMPLE rows
    sample = matrix(picked.column("v"), dims)
    depth = max(0, min(math.ceil(math.log2(n / leaf_size)),
                       math.floor(math.log2(max(1, len(sample) / SAMPLE_LEAF)))))
    forest = Trees(sample, trees, depth, spill * math.sqrt(2 * (1 - threshold) / dims))

    def assign(batches):
        for batch in batches:
            for d in set(batch.column("dims").to_pylist()):
                part = batch.filter(pc.equal(batch.column("dims"), d))
                row, leaf = forest.leaves(matrix(part.column("v"), d))
                ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("rep", "times", "dims", "v")]
                    + [pa.ListArray.from_arrays(pa.array(ends), pa.array(leaf))],
                    ["rep", "times", "dims", "v", "leaves"])

    kind = classes.schema["v"].dataType.simpleString()
    placed = classes.select("rep", "times", "dims", "v").mapInArrow(
        assign, f"rep long, times long, dims int, v {kind}, leaves array<long>")
    members = placed.select("*", F.explode("leaves").alias("leaf"))
    hot = (placed.select("dims", F.explode("leaves").alias("leaf")).groupBy("leaf", "dims").count()
           .where(F.col("count") > leaf_limit)
           .select("leaf", "dims", F.ceil(F.col("count") / leaf_limit).cast("int").alias("parts")))
    members = members.join(hot, ["leaf", "dims"], "left").withColumn(
        "parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("rep", "leaf"), F.col("parts")).cast("int")
    tasks = (members.withColumn("part", part)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumns({"i": F.least("part", "with"), "j": F.greatest("part", "with")}))

    def link(key: tuple[pa.Scalar, ...], members: pa.Table) -> pa.Table:
        leaf, dims, i, j = (k.as_py() for k in key)
        rep, times, part = (members.column(c).to_numpy() for c in ("rep", "times", "part"))
        lists = members.column("leaves").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        sets = np.full((len(rep), sizes.max()), -1, np.int64)
        sets[np.arange(sets.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
        links, top = compare(leaf, matrix(members.column("v"), dims), part, (i, j), rep, times, sets,
                             threshold)
        keep = (links > 0) | (top != np.arange(len(rep)))
        return pa.table({"rep": rep[keep], "links": links[keep], "top": rep[top[keep]]})

    found = materialize(
        tasks.select("leaf", "dims", "i", "j", "rep", "times", "part", "v", "leaves")
        .groupBy("leaf", "dims", "i", "j").applyInArrow(link, "rep long, links long, top long"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    nodes = components(found, "rep", "top").withColumnRenamed("node", "rep")
    known = (classes.select("k1", "k2", "rep", "times").join(counts, "rep", "left")
             .join(nodes, "rep", "left")
             .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    # rows without a usable vector find no class
    found = rows.withColumn("k1", F.when(F.col("v").isNotNull(), F.col("k1"))).drop("v").join(
        known, ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"),
                        component.eqNullSafe(F.col("vec_id")).alias("kept"))
