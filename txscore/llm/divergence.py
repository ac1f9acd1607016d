"""How the sources of a language differ in their words, over a transducer vocabulary.

Vocabulary. A term is a run of ASCII letters and characters beyond ASCII, A-Z in lower case. A
language keeps the terms that occur in at least ``min_docs`` of its documents. The kept terms are
sorted across the cluster and cut into shards, and each shard becomes a minimal acyclic transducer,
built in one pass over its sorted terms: equal suffixes share states, and the numbers on a
path add up to the term's ordinal in the order of its UTF-8 bytes. Ordinals of a language run on
from shard to shard.

Recount. The texts stream through the transducers a second time, so that only (source, ordinal)
counts of kept terms are shuffled. If all transducers together exceed ``max_broadcast`` bytes, they
aren't sent to the tasks: the terms, counted by task, are shuffled to the shard that would hold them
and pass through its transducer there. Both ways give the same counts.

Measures. With N the occurrences of kept terms in a group, V their number, a term has p = 1 +
floor(scale * (count + 1) / (N + V)), all in whole numbers. Pairs: the sum over all kept terms of
floor((p - q)^2 / q), q being another source's, from one vector of counts for each term; a task
adds the vectors up for all pairs of sources at once. Terms: the ``top`` terms that a source uses
more than its language does, by the same measure. Ties go by ordinal.

Null text, language or source counts as empty text. Each row is a document, repeated rows too.
An empty table gives an empty result; a group without terms still has its pairs.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.llm.common import require, slices
from txscore.operators.ordered import join_small
from txscore.session import materialize

MIN_DOCS, SCALE, TOP = 3, 1_000_000_000, 200
#: Terms of one transducer, and bytes of transducers that may go to every task.
SHARD_TERMS, MAX_BROADCAST = 1 << 17, 64 << 20
#: Terms that a task counts before it hands them on, and cells of the vectors it holds.
HELD_TERMS, HELD_CELLS = 400_000, 1 << 20
#: Bytes of terms as they are counted (A-Z in lower case), all others as a space.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0x80 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class Transducer:
    """Minimal acyclic transducer from terms (bytes) to their ordinals, in flat arrays: the sorted
    keys ``state << 8 | byte`` of all edges, their targets and the numbers to add."""

    def __init__(self, keys: np.ndarray, target: np.ndarray, add: np.ndarray, final: np.ndarray, root: int):
        self.keys, self.target, self.add, self.final, self.root = keys, target, add, final, root

    @classmethod
    def build(cls, ordered: Iterable[bytes]) -> Transducer:
        """From distinct terms in order. The states along the last term are open; those past the
        prefix shared with the next term are closed, each replaced by an equal closed one if any."""
        known: dict[tuple, int] = {}
        below: list[int] = []  # terms that a closed state accepts
        path: list[list] = [[False, []]]  # of open states: final, closed edges
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, edges = path.pop()
                state = known.setdefault((final, *edges), len(below))
                if state == len(below):
                    below.append(final + sum(below[t] for _, t in edges))
                path[-1][1].append((last[len(path) - 1], state))

        for term in ordered:
            shared = 0
            while shared < min(len(term), len(last)) and term[shared] == last[shared]:
                shared += 1
            close(shared)
            path.extend([False, []] for _ in term[shared:])
            path[len(term)][0] = True
            last = term
        close(0)
        final, edges = path[0]
        root = known.setdefault((final, *edges), len(below))
        keys, target, add, ends = [], [], [], np.zeros(len(known), bool)
        for (is_end, *edges), state in known.items():
            ends[state] = is_end
            before = int(is_end)
            for byte, to in edges:
                keys.append(state << 8 | byte)
                target.append(to)
                add.append(before)
                before += below[to]
        order = np.argsort(np.array(keys, np.int64))
        return cls(*(np.array(x, np.int64)[order] for x in (keys, target, add)), ends, root)

    def dumps(self) -> bytes:
        """One block of numbers: 32-bit where they fit."""
        head = np.array([len(self.keys), len(self.final), self.root], np.int64)
        return b"".join(x.tobytes() for x in (head, self.keys, self.target.astype(np.int32),
                                              self.add.astype(np.int32), self.final))

    @classmethod
    def loads(cls, data: bytes) -> Transducer:
        n, states, root = np.frombuffer(data, np.int64, 3).tolist()
        keys = np.frombuffer(data, np.int64, n, 24)
        target, add = (np.frombuffer(data, np.int32, n, 24 + 8 * n + 4 * n * i) for i in (0, 1))
        return cls(keys, target, add, np.frombuffer(data, bool, states, 24 + 16 * n), root)

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """Ordinal of each term, -1 of any other. All words take a step at a time."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return out
        length = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(length) - length
        flat = np.frombuffer(b"".join(words), np.uint8)
        at = np.arange(len(words))
        state = np.full(len(words), self.root, np.int64)
        ordinal = np.zeros(len(words), np.int64)
        step = 0
        while len(at):
            over = length[at] == step
            done = over & self.final[state]
            out[at[done]] = ordinal[done]
            at, state, ordinal = at[~over], state[~over], ordinal[~over]
            key = state << 8 | flat[start[at] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[edge] == key
            at, edge = at[ok], edge[ok]
            state, ordinal = self.target[edge].astype(np.int64), ordinal[ok] + self.add[edge]
            step += 1
        return out

    def terms(self) -> Iterator[bytes]:
        """All terms in order."""
        edge = np.searchsorted(self.keys, np.arange(len(self.final) + 1) << 8).tolist()
        byte, target, final = (self.keys & 255).tolist(), self.target.tolist(), self.final.tolist()
        todo = [(self.root, b"")]
        while todo:
            state, prefix = todo.pop()
            if final[state]:
                yield prefix
            for e in range(edge[state + 1] - 1, edge[state] - 1, -1):
                todo.append((target[e], prefix + bytes([byte[e]])))


def _rows(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to)
                         for c, to in ((lang, "lang"), (source, "source"))],
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def _kept(rows: DataFrame, min_docs: int) -> DataFrame:
    """lang, term of the terms that enough documents of a language hold."""

    def out(held: dict) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(counts)), pa.array(list(counts), pa.binary()),
                 pa.array(list(counts.values()), pa.int64())], ["lang", "term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)
        for part in slices(batches, "text"):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                held[lang].update(set(terms(text)))
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from out(held)
                held.clear()
        yield from out(held)

    return (rows.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
            .groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
            .select("lang", "term"))


def vocabulary(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """shard, lang, low (its first term), n, base (ordinal of that term), data (the transducer)."""
    parts = max(1, -(-kept.count() // shard_terms))
    order = kept.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        now, held = None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "shard": [shard], "lang": [now], "low": [held[0]], "n": [len(held)],
                "data": [Transducer.build(held).dumps()]}, _SHARD)

        for batch in batches:
            for lang, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist(), strict=True):
                if held and (lang != now or len(held) >= shard_terms):
                    yield out()
                    shard, held = shard + 1, []
                now = lang
                held.append(term)
        if held:
            yield out()

    shards = materialize(order.mapInArrow(run, "shard long, lang string, low binary, n long, data binary"))
    before = Window.partitionBy("lang").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return materialize(shards.join(bases, "shard"))


_SHARD = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("low", pa.binary()), ("n", pa.int64()),
                    ("data", pa.binary())])
_COUNTS = "lang string, source string, ordinal long, n long"


_FIELDS = ["lang", "source", "ordinal", "n"]


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict[str, Counter]]]:
    """(lang, counts of terms by source) of the texts of a task, as often as enough terms are held."""
    held: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))

    def size() -> int:
        return sum(len(c) for by in held.values() for c in by.values())

    for part in slices(batches, "text"):
        for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")),
                                      strict=True):
            held[lang][source].update(terms(text))
        if size() > HELD_TERMS:
            yield from held.items()
            held.clear()
    yield from held.items()


def _place(lows: list[tuple[str, bytes]], lang: str, words: list[bytes]) -> np.ndarray:
    """Place of the shard that would hold each term, -1 where no shard does."""
    first = bisect.bisect_left(lows, (lang, b""))
    stop = first
    while stop < len(lows) and lows[stop][0] == lang:
        stop += 1
    own = [low for _, low in lows[first:stop]]
    at = np.array([bisect.bisect_right(own, w) for w in words], np.int64) - 1
    return np.where(at >= 0, at + first, -1)


def recount(rows: DataFrame, shards: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """lang, source, ordinal, n of all kept terms that occur."""
    spark = rows.sparkSession
    # one row for each shard; their first terms and places go to the tasks, whole transducers
    # only within the bound
    size = shards.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    if size <= max_broadcast:
        places = sorted((r.lang, bytes(r.low), r.base, bytes(r.data)) for r in shards.collect())
        sent = spark.sparkContext.broadcast(places)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lows = [(lang, low) for lang, low, _, _ in sent.value]
            loaded = [(base, Transducer.loads(data)) for _, _, base, data in sent.value]
            for lang, by in _streamed(batches):
                words = list(set().union(*by.values()))  # a term of several sources walks once
                place, found = _place(lows, lang, words), np.full(len(words), -1, np.int64)
                for i in np.unique(place[place >= 0]).tolist():
                    base, transducer = loaded[i]
                    at = np.flatnonzero(place == i)
                    ordinal = transducer.ordinals([words[k] for k in at.tolist()])
                    found[at] = np.where(ordinal >= 0, ordinal + base, -1)
                known = dict(zip(words, found.tolist(), strict=True))
                for source, counts in by.items():
                    ordinal = np.array([known[w] for w in counts], np.int64)
                    n = np.array(list(counts.values()), np.int64)[ordinal >= 0]
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(n)), pa.repeat(source, len(n)),
                                                      pa.array(ordinal[ordinal >= 0]), pa.array(n)], _FIELDS)

        found = rows.mapInArrow(run, _COUNTS)
    else:
        lows = sorted((r.lang, bytes(r.low), r.shard) for r in shards.select("lang", "low", "shard").collect())
        sent_lows = spark.sparkContext.broadcast(lows)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lows = [x[:2] for x in sent_lows.value]
            shard = np.array([x[2] for x in sent_lows.value] + [-1], np.int64)
            for lang, by in _streamed(batches):
                for source, counts in by.items():
                    words, k = list(counts), len(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard[_place(lows, lang, words)]), pa.repeat(lang, k), pa.repeat(source, k),
                         pa.array(words, pa.binary()), pa.array(list(counts.values()), pa.int64())],
                        ["shard", "lang", "source", "term", "n"])

        counted = (rows.mapInArrow(place, "shard long, lang string, source string, term binary, n long")
                   .where("shard >= 0").groupBy("shard", "lang", "source", "term").agg(F.sum("n").alias("n"))
                   .withColumn("data", F.lit(None).cast("binary")).withColumn("base", F.lit(None).cast("long")))
        none = F.lit(None).cast("string")
        vocab = shards.select("shard", "lang", none.alias("source"), none.cast("binary").alias("term"),
                              F.lit(0).cast("long").alias("n"), "data", "base")
        # a shard's transducer stands before its terms, which stream through it
        both = counted.unionByName(vocab).repartition("shard").sortWithinPartitions("shard", F.col("base").isNull())

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base, transducer = 0, None
            for batch in batches:
                starts = np.flatnonzero(~np.array(batch.column("base").is_null())).tolist()
                for a, b in zip([0, *starts], [*starts, batch.num_rows], strict=True):
                    part = batch.slice(a, b - a)
                    if a in starts and len(part):
                        base, transducer = part.column("base")[0].as_py(), Transducer.loads(
                            part.column("data")[0].as_py())
                        part = part.slice(1)
                    if not len(part):
                        continue
                    ordinal = transducer.ordinals(part.column("term").to_pylist())
                    ok = np.flatnonzero(ordinal >= 0)
                    kept = part.take(pa.array(ok))
                    yield pa.RecordBatch.from_arrays([kept.column("lang"), kept.column("source"),
                                                      pa.array(ordinal[ok] + base), kept.column("n")], _FIELDS)

        found = both.mapInArrow(walk, _COUNTS)
    return found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """p of a term with ``n`` of ``total`` occurrences of ``terms`` kept terms. Decimals: a thousand
    million times a count may leave 64 bits."""
    up = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 1 AS DECIMAL(20,0))"
    return F.expr(f"1 + ({up}) div CAST(greatest({total} + {terms}, 1) AS DECIMAL(20,0))")


def _pair_sums(vectors: DataFrame) -> DataFrame:
    """lang, g, h, value: partial sums over terms, for all pairs of a language's sources."""

    def out(lang: str, held: list[np.ndarray]) -> pa.RecordBatch:
        p = np.stack(held)
        k = p.shape[1]
        sums = np.stack([((p[:, g:g + 1] - p) ** 2 // p).sum(axis=0) for g in range(k)])
        g, h = np.divmod(np.arange(k * k), k)
        return pa.RecordBatch.from_arrays([pa.array([lang] * (k * k), pa.string()), pa.array(g), pa.array(h),
                                           pa.array(sums.ravel())], ["lang", "g", "h", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = defaultdict(list)
        cells = 0
        for batch in batches:
            for row in batch.to_pylist():
                p = np.array(row["none"], np.int64)
                p[row["at"]] = row["p"]
                held[row["lang"]].append(p)
                cells += len(p)
                if cells > HELD_CELLS:
                    for lang, rows in held.items():
                        yield out(lang, rows)
                    held.clear()
                    cells = 0
        for lang, rows in held.items():
            yield out(lang, rows)

    return (vectors.mapInArrow(run, "lang string, g long, h long, value long")
            .groupBy("lang", "g", "h").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP, shard_terms: int = SHARD_TERMS,
          max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item (another source, or a term), value, rank.

    Pairs have all ranks, terms the first ``top``. The number of sources of a language is the only
    size that one row grows with, as its pairs are part of the result."""
    require(docs, lang_col, source_col, text_col)
    rows = _rows(docs, lang_col, source_col, text_col)
    shards = vocabulary(materialize(_kept(rows, min_docs)), shard_terms)
    counts = materialize(recount(rows, shards, max_broadcast))

    kept = shards.groupBy("lang").agg(F.sum("n").alias("v"))
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = (rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left")
              .join(kept, "lang", "left").na.fill(0, ["size", "v"]))
    # sources of a language in order; ``none``: what each gives a term it hasn't got
    sources = F.sort_array(F.collect_list(F.struct("source", "size", _share("0", "size", "v").alias("none"))))
    langs = materialize(groups.groupBy("lang").agg(F.first("v").alias("v"), F.sum("size").alias("total"),
                                                   sources.alias("sources")))
    placed = langs.select("lang", "v", "total", F.posexplode("sources").alias("i", "s")).select(
        "lang", "v", "total", "i", "s.source", "s.size")

    shared = join_small(counts, placed.drop("total"), ["lang", "source"]).withColumn("p", _share("n", "size", "v"))
    vectors = materialize(shared.groupBy("lang", "ordinal").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("i", "p")).alias("own")))

    wide = join_small(vectors, langs.select("lang", F.col("sources.none").alias("none")), "lang")
    sums = _pair_sums(wide.select("lang", "none", F.col("own.i").alias("at"), F.col("own.p").alias("p")))
    other = placed.select("lang", F.col("i").alias("h"), F.col("source").alias("item"))
    pairs = (placed.select("lang", "source", F.col("i").alias("g")).join(other, "lang").where("g <> h")
             .join(sums, ["lang", "g", "h"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.coalesce("value", F.lit(0)).cast("long").alias("value"), F.col("h").alias("order")))

    whole = join_small(vectors, langs.select("lang", "v", "total"), "lang")
    leads = (whole.withColumn("q", _share("n", "total", "v")).select("lang", "ordinal", "q", F.explode("own").alias("o"))
             .where("o.p > q").select("lang", "ordinal", F.col("o.i").alias("i"),
                                      F.expr("((o.p - q) * (o.p - q)) div q").alias("value")))
    # ranks within the limit are taken before the shuffle too
    order = Window.partitionBy("lang", "i").orderBy(F.desc("value"), "ordinal")
    leads = leads.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    terms_of = join_small(_listed(shards), leads, ["lang", "ordinal"])
    found = join_small(terms_of, placed.select("lang", "i", "source"), ["lang", "i"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "order")
    ranked = pairs.withColumn("rank", F.row_number().over(by)).drop("order")
    return ranked.unionByName(found)


def _listed(shards: DataFrame) -> DataFrame:
    """lang, ordinal, term: the transducers read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = [t.decode() for t in Transducer.loads(row["data"]).terms()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(words), pa.string()),
                     pa.array(row["base"] + np.arange(len(words))), pa.array(words, pa.string())],
                    ["lang", "ordinal", "term"])

    return shards.select("lang", "base", "data").mapInArrow(run, "lang string, ordinal long, term string")
