"""SimHash near-duplicates found with BK-trees.

Fingerprints. A text is lower-cased (A-Z), cut into words at ASCII white space, and
every run of ``words`` words is hashed (XXH64, seed 42). A bit of the fingerprint is set
if it is set in over half the hashes; a text with fewer words is one shingle, a text
without words has fingerprint zero. Null text counts as empty.

Search. Equal fingerprints are one node. Two fingerprints that differ in at most
``radius`` bits agree in at least one of ``radius + 1`` bit blocks, so a shard is the
fingerprints that share the value of one block. Each shard has its own BK-tree:
children are keyed by the integer Hamming distance to their parent. The queries of a
shard go to the task that holds its tree (a shuffle by shard, as nothing that grows with
the corpus may be broadcast), and follow only the edges whose key lies within the
radius of the distance to the parent. All trees of a task are built and searched
level by level in flat arrays. A subtree whose fingerprints are already connected to
the query is left out, so a dense group of near copies costs no all-pairs search, and a
shard hands on only a spanning forest of its links.

A shard with over ``shard_limit`` fingerprints (a hot block value) is cut into parts by a
hash; each part's tree is searched by every part in a task of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import require, slices
from txscore.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SEED = 42
SHINGLE_WORDS = 3
RADIUS = 3
BITS = 64
#: Fingerprints in one task's tree of a shard.
SHARD_LIMIT = 50_000
#: Hashes turned into bits at once.
HASHES = 1 << 15
#: Query and node pairs looked at together.
FRONTIER = 1 << 18
#: Queries searched before trees are marked anew: few at first, when most marking pays.
FIRST_QUERIES, QUERIES = 1 << 8, 1 << 14


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    import xxhash

    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    if len(w) < words:
        shingles = [" ".join(w)]
    else:
        shingles = map(" ".join, zip(*(w[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(h), HASHES):
        bits = np.unpackbits(h[i:i + HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, th (a hash of the text that tells apart rows of one id), fp (the 64 bits as a
    signed long)."""
    require(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"), _text_hash(text_col).alias("th"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            fp = np.array([fingerprint(t, words) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("th"), pa.array(fp.view(np.int64))],
                ["doc_id", "th", "fp"])

    return rows.mapInArrow(run, "doc_id long, th long, fp long")


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def find(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    while True:
        up = parent[nodes]
        if (up == nodes).all():
            return nodes
        nodes = up


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; the smallest index of a set is its root."""
    while len(a):
        a, b = find(parent, a), find(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


class Forest:
    """BK-trees of many shards in flat arrays; node numbers are places in ``values``."""

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        self.values = values
        n = len(values)
        self.parent = np.full(n, -1, np.int64)
        self.edge = np.zeros(n, np.int64)  # distance to the parent
        self.levels: list[np.ndarray] = []
        self.roots: dict[int, int] = {}
        order = np.argsort(shard, kind="stable")
        group = np.unique(shard[order], return_inverse=True)[1] if n else order
        above = np.full(n, -1, np.int64)  # parent of each group's root, by group
        key = np.zeros(n, np.int64)
        rest = order
        while len(rest):
            lead = np.append(True, group[1:] != group[:-1])
            roots = rest[lead]
            of = np.cumsum(lead) - 1
            self.parent[roots], self.edge[roots] = above[lead], key[lead]
            self.levels.append(roots)
            rest, of = rest[~lead], of[~lead]
            top = roots[of]
            d = np.bitwise_count(values[rest] ^ values[top]).astype(np.int64)
            slot = of * (BITS + 1) + d
            by = np.argsort(slot, kind="stable")
            rest, above, key, group = rest[by], top[by], d[by], slot[by]
        self.root_of = {int(s): int(r) for s, r in zip(shard[self.levels[0]], self.levels[0],
                                                       strict=True)} if n else {}
        # children of a node, by edge key
        kids = np.concatenate(self.levels[1:]) if len(self.levels) > 1 else np.zeros(0, np.int64)
        by = np.lexsort((self.edge[kids], self.parent[kids]))
        self.kids = kids[by]
        self.kid_key = self.parent[self.kids] * (BITS + 1) + self.edge[self.kids]

    def search(self, q: np.ndarray, own: np.ndarray, roots: np.ndarray, radius: int,
               sets: np.ndarray, base: int) -> None:
        """Unite query i (set ``own[i]``) with every node within the radius of q[i] in the
        tree of ``roots[i]``. Set of node j: ``sets[base + j]``."""
        start, count = 0, FIRST_QUERIES
        while start < len(q):
            whole = self.uniform(sets, base)
            stop = min(start + count, len(q))
            todo = [(np.arange(start, stop), roots[start:stop])]
            start, count = stop, min(2 * count, QUERIES)
            while todo:
                i, node = todo.pop()
                if len(i) > FRONTIER:
                    half = len(i) // 2
                    todo += [(i[:half], node[:half]), (i[half:], node[half:])]
                    continue
                known = whole[node]
                same = known >= 0
                same[same] = find(sets, own[i[same]]) == find(sets, known[same])
                i, node = i[~same], node[~same]
                if not len(i):
                    continue
                d = np.bitwise_count(q[i] ^ self.values[node]).astype(np.int64)
                near = d <= radius
                unite(sets, own[i[near]], base + node[near])
                low = np.searchsorted(self.kid_key, node * (BITS + 1) + np.maximum(d - radius, 0))
                high = np.searchsorted(self.kid_key, node * (BITS + 1) + np.minimum(d + radius, BITS),
                                       side="right")
                n = high - low
                if n.sum():
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    todo.append((np.repeat(i, n), self.kids[np.repeat(low, n) + step]))

    def uniform(self, sets: np.ndarray, base: int) -> np.ndarray:
        """By node, the set that its whole subtree belongs to, else -1."""
        mark = find(sets, base + np.arange(len(self.values)))
        mixed = np.zeros(len(mark), bool)
        for level in reversed(self.levels[1:]):
            bad = mixed[level] | (mark[level] != mark[self.parent[level]])
            mixed[self.parent[level[bad]]] = True
        return np.where(mixed, -1, mark)


def shard_links(values: np.ndarray, shard: np.ndarray, side: np.ndarray,
                radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (value, smaller-placed value of its set) within shards. ``side`` 0: in
    the tree and a query; 1: only in the tree; 2: only a query."""
    tree = np.flatnonzero(side < 2)
    ask = np.flatnonzero(side != 1)
    order = np.concatenate([tree, np.flatnonzero(side == 2)])
    place = np.empty(len(values), np.int64)
    place[order] = np.arange(len(order))
    sets = np.arange(len(order))
    if len(tree) and len(ask):
        forest = Forest(values[tree], shard[tree])
        roots = np.array([forest.root_of.get(s, -1) for s in shard[ask].tolist()], np.int64)
        ask, roots = ask[roots >= 0], roots[roots >= 0]
        forest.search(values[ask], place[ask], roots, radius, sets, 0)
    top = find(sets, np.arange(len(order)))
    linked = np.flatnonzero(top != np.arange(len(order)))
    return values[order[linked]], values[order[top[linked]]]


def near_links(fps: DataFrame, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints of column ``fp``: a spanning forest of all
    pairs that differ in at most ``radius`` bits."""
    distinct = fps.select("fp").distinct()
    blocks = radius + 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = F.array(*[
        F.lit(i).cast("long") * F.lit(1 << 58) + F.shiftrightunsigned("fp", edges[i]).bitwiseAND(
            F.lit((1 << (edges[i + 1] - edges[i])) - 1)) for i in range(blocks)])
    sharded = distinct.select("fp", F.explode(keys).alias("shard"))
    # hot shards are cut into parts; part i is searched by all parts, each in its own task
    sizes = sharded.groupBy("shard").count().where(F.col("count") > shard_limit)
    hot = sizes.select(F.col("shard").alias("hot_shard"),
                       F.ceil(F.col("count") / shard_limit).cast("long").alias("parts"))
    marked = sharded.join(hot, F.col("shard") == F.col("hot_shard"), "left")
    part = F.pmod(F.xxhash64("fp", "shard"), F.col("parts"))
    plain = marked.where("parts is null").select(
        "fp", "shard", F.lit(0).alias("side"), F.lit(0).cast("long").alias("tree"))
    cut = (marked.where("parts is not null").withColumn("part", part)
           .withColumn("tree", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
           .withColumn("asker", F.explode(F.when(F.col("tree") == F.col("part"), F.sequence(
               F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("part"))))
           .select("fp", "shard", "tree", "asker",
                   F.when(F.col("tree") != F.col("part"), 2)
                   .when(F.col("asker") == F.col("part"), 0).otherwise(1).alias("side")))
    rows = plain.withColumn("asker", F.lit(0).cast("long")).unionByName(cut)
    rows = rows.withColumn("key", F.xxhash64("shard", "tree", "asker")).select("fp", "key", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        values, shard, side = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False)
                                               for b in held]) for c in ("fp", "key", "side"))
        a, b = shard_links(values.view(np.uint64), shard, side, radius)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                         ["a", "b"])

    return rows.repartition("key").mapInArrow(run, "a long, b long").distinct()


def _classes(fps: DataFrame, radius: int, shard_limit: int) -> DataFrame:
    """fp, root (the smallest linked fingerprint) of every distinct fingerprint."""
    nodes = components(near_links(fps, radius, shard_limit), "a", "b")
    distinct = fps.select("fp").distinct()
    return (distinct.join(nodes, distinct.fp == nodes.node, "left")
            .select("fp", F.coalesce("component", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, radius: int = RADIUS,
                    shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (the
    smallest doc_id reachable over links of at most ``radius`` bits, itself included).

    Rows with a null doc_id take part in links, and their component is the smallest doc_id
    that is not null, if there is any. Repeated rows give repeated results."""
    fps = fingerprints(docs, id_col, text_col, words).checkpoint()
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = _classes(fps, radius, shard_limit).join(least, "fp")
    roots = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    found = classes.join(roots, "root").select(F.col("fp").alias("class_fp"), "component_id")
    return (fps.join(found, F.col("fp") == F.col("class_fp"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words: int = SHINGLE_WORDS, radius: int = RADIUS,
             shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """One row of ``docs``, with all its columns, for each group of near-duplicates: that of the
    smallest doc_id (rows without one come last), and of several with this id, one with the
    smallest fingerprint."""
    require(docs, id_col, text_col)
    own, key = "th", "id0"
    while {own, key} & set(docs.columns):
        own, key = own + "_", key + "_"
    none = F.lit(-(1 << 63))
    fps = fingerprints(docs, id_col, text_col, words).checkpoint()
    classes = _classes(fps, radius, shard_limit)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "th")
    # the first row of each fingerprint, then of each group: copies are combined before a join
    firsts = fps.groupBy("fp").agg(F.min(first).alias("first"))
    chosen = (firsts.join(classes, "fp").groupBy("root").agg(F.min("first").alias("first"))
              .select(F.coalesce("first.doc_id", none).alias(key), F.col("first.th").alias(own)))
    rows = docs.withColumns({key: F.coalesce(F.col(id_col).cast("long"), none), own: _text_hash(text_col)})
    # repeated rows meet in the join's partitions, so texts move once
    return rows.join(chosen, [key, own], "left_semi").dropDuplicates([key, own]).drop(key, own)
