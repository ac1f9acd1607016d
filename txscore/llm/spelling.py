"""Spelling variants of a corpus's words, grouped by search schemes on a bidirectional FM-index.

Words. Runs of letters ([A-Za-z and U+00C0 to U+00FF]) of whole texts, A-Z in lower case. A run
whose crc32 of ``<id>:<run>`` is divisible by ``damage`` loses one letter first (a reproducible
misspelling; 0 leaves runs alone). Words of at least ``min_length`` letters and ``min_count``
occurrences over all documents form the vocabulary.

Search. Words at edit distance one share a half exactly: an error leaves either the first or the
second half of a word whole. A vocabulary is written as ``$word$word$`` and indexed in both
directions (counts over the Burrows-Wheeler transforms of the text and of its reverse), so that
a pattern's interval of suffix ranks can grow at either end. Scheme one matches ``$`` and the
first half, then extends to the right, allowing one error; scheme two matches the second half and
``$``, then extends to the left. Intervals that begin with ``$`` are ranked as the words are, so the
rank is the word found. All words of an index are searched together, in flat arrays. Scheme two
leaves out what scheme one finds.

Shards. For each scheme a word asks in the shard of its (length, whole half), and is indexed in the
shards of the (length, half) that a neighbour's query can have (three lengths). Shards are hashed
into buckets sized from the counted vocabulary; a bucket over ``shard_chars`` letters is cut into
parts, and each part of the askers meets each part of the index in a task of its own. Tasks hand
on one row for each word (its number of near words and the best of them), never pairs.

Null text has no words; a null id is written as an empty string. Repeated rows count each. An
empty table, or one without such words, gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import require, slices
from txscore.session import materialize

MIN_LENGTH, MIN_COUNT, DAMAGE, RATIO = 6, 5, 199, 5
#: Letters that one index holds, as a target.
SHARD_CHARS = 1 << 17
#: Words that a task counts before it hands them on.
HELD_WORDS = 200_000
#: Cells of a table of counts; longer texts get a row for every few places only.
CELLS = 1 << 24
#: States or cells that the search looks at together.
FRONTIER = 1 << 20
#: Letters of Latin-1 as they are counted (A-Z in lower case), all else as a space.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters, one Latin-1 byte each."""
    return text.encode("latin-1", "replace").translate(LETTERS).split()


def word_counts(docs: DataFrame, id_col: str, text_col: str, min_length: int, damage: int) -> DataFrame:
    """word, n of all words of at least ``min_length`` letters."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.col(text_col).cast("string").alias("text")).where("text is not null")

    def out(held: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                           pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for part in slices(batches, "text"):
            for own, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                seed = zlib.crc32(f"{own}:".encode())
                for word, n in Counter(runs(text)).items():
                    if len(word) < min_length:
                        continue
                    if damage:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                        if h % damage == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < min_length:
                                continue
                    held[word] = held.get(word, 0) + n
            if len(held) > HELD_WORDS:
                yield out(held)
                held = {}
        yield out(held)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Places of a text's suffixes in order (its last code is its smallest and occurs once)."""
    n, base = len(codes), int(codes.max()) + 1
    width = max(1, int(62 / math.log2(base + 1)))
    rank = np.zeros(n, np.int64)
    for i in range(width):  # the first codes of a suffix as one number
        rank = rank * base + np.append(codes[i:], np.zeros(min(i, n), np.int64))[:n]
    while True:
        order = np.argsort(rank, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.append(0, rank[order][1:] != rank[order][:-1]))
        if new[order[-1]] == n - 1:
            return order
        rank = new * (n + 1) + np.append(new[width:] + 1, np.zeros(min(width, n), np.int64))[:n]
        width *= 2


class Counts:
    """For a transform ``b``: how many of its first r codes are smaller than c."""

    def __init__(self, b: np.ndarray, codes: int):
        self.step = max(1, -(-len(b) * (codes + 1) // CELLS))
        blocks = len(b) // self.step + 1
        per = np.bincount(np.arange(len(b)) // self.step * codes + b, minlength=blocks * codes)
        self.less = np.zeros((blocks, codes + 1), np.int32)
        np.cumsum(np.cumsum(per.reshape(blocks, codes), axis=1), axis=0, out=self.less[:, 1:], dtype=np.int32)
        self.less[1:], self.less[0] = self.less[:-1].copy(), 0
        self.b = np.append(b, np.full(self.step, codes))

    def below(self, r: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = self.less[r // self.step, c].astype(np.int64)
        for i in range(self.step - 1):
            out += (r % self.step > i) & (self.b[r // self.step * self.step + i] < c)
        return out

    def rows(self, r: np.ndarray) -> np.ndarray:
        """``below(r, c)`` for every c."""
        out = self.less[r // self.step].astype(np.int64)
        every = np.arange(out.shape[1])
        for i in range(self.step - 1):
            own = (r % self.step > i)[:, None]
            out += own & (self.b[r // self.step * self.step + i][:, None] < every)
        return out


class BiIndex:
    """Bidirectional FM-index of sorted distinct words (Latin-1 bytes). A state is the interval of
    a pattern: its low ends in the index of the text and of its reverse, and its size. Codes:
    0 the end, 1 the delimiter, then the letters in order."""

    RIGHT, LEFT = 1, 0

    def __init__(self, words: list[bytes]):
        text = np.frombuffer(b"\x01" + b"\x01".join(words) + b"\x01", np.uint8)
        letters = np.unique(text)
        self.code = np.zeros(256, np.int64)
        self.code[letters] = np.arange(1, len(letters) + 1)
        self.codes = len(letters) + 1
        codes = self.code[text]
        self.tables = []
        for one in (codes, codes[::-1]):
            ended = np.append(one, 0)
            self.tables.append(Counts(ended[suffix_array(ended) - 1], self.codes))
        self.first = np.append(0, np.cumsum(np.bincount(ended, minlength=self.codes)))
        self.delimiters = len(words) + 1

    def extend(self, side: int, low: np.ndarray, size: np.ndarray,
               c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states of the patterns with code ``c`` added at one end."""
        t, at = self.tables[side], low[side]
        a, b = t.below(at, c), t.below(at + size, c)
        own = t.below(at, c + 1) - a
        return self._moved(side, low, c, own, b - a), t.below(at + size, c + 1) - b - own

    def _moved(self, side: int, low: np.ndarray, c: np.ndarray, own: np.ndarray,
               smaller: np.ndarray) -> np.ndarray:
        out = np.empty_like(low)
        out[side] = self.first[c] + own
        out[1 - side] = low[1 - side] + smaller
        return out

    def branches(self, side: int, low: np.ndarray,
                 size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(state, letter, low, size) of all extensions by a letter that occur."""
        t = self.tables[side]
        a, b = t.rows(low[side]), t.rows(low[side] + size)
        sizes = np.diff(b - a, axis=1)
        i, c = np.nonzero(sizes[:, 2:])
        c = c + 2
        moved = self._moved(side, low[:, i], c, a[i, c + 1] - a[i, c], b[i, c] - a[i, c])
        return i, c, moved, sizes[i, c]

    def one_error(self, words: list[bytes], whole: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of the indexed words at edit distance one from a query whose first (RIGHT) or
        last (LEFT) ``whole`` letters they share. Words are numbered in order."""
        length = np.array([len(w) for w in words], np.int64)
        asked, found = [], []
        start = 0
        while start < len(words):  # queries in parts, so that the padded table stays small
            stop, widest = start, 0
            while stop < len(words) and (stop == start or max(widest, length[stop]) * (stop + 1 - start)
                                         <= FRONTIER and (stop - start) * self.codes < FRONTIER):
                widest = max(widest, length[stop])
                stop += 1
            table = np.ones((stop - start, widest + 1), np.int64)
            for i, w in enumerate(words[start:stop]):
                # a letter that the index lacks is code 0, which no pattern is extended by
                table[i, :len(w)] = self.code[np.frombuffer(w if side else w[::-1], np.uint8)]
            q, word = self._search(table, length[start:stop], whole[start:stop], side)
            asked.append(q + start)
            found.append(word)
            start = stop
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *asked]), np.concatenate([none, *found])

    def _search(self, table: np.ndarray, length: np.ndarray, whole: np.ndarray,
                side: int) -> tuple[np.ndarray, np.ndarray]:
        q = np.arange(len(table))
        low = np.full((2, len(q)), self.first[1])
        size = np.full(len(q), self.delimiters)
        asked, found, waiting, held = [], [], [], 0

        def finish() -> None:
            nonlocal held
            if not waiting:
                return
            q, low, size, at = (np.concatenate(x, axis=-1) for x in zip(*waiting, strict=True))
            waiting.clear()
            held = 0
            while len(q):
                low, size = self.extend(side, low, size, table[q, at])
                size[table[q, at] == 0] = 0
                done = (size > 0) & (at == length[q])
                asked.append(q[done])
                found.append(low[0, done] - 2)
                stay = (size > 0) & ~done
                q, low, size, at = q[stay], low[:, stay], size[stay], at[stay] + 1

        for j in range(table.shape[1]):
            error = whole[q] <= j  # the exact half is matched
            if error.any():
                k, klow, ksize = q[error], low[:, error], size[error]
                i, c, blow, bsize = self.branches(side, klow, ksize)
                of, ended = k[i], length[k[i]] == j
                other = c != table[of, j]
                extra = other | ended  # inserted letters stand after a run of their own kind
                waiting.append((of[extra], blow[:, extra], bsize[extra], np.full(extra.sum(), j)))
                swap = other & ~ended
                waiting.append((of[swap], blow[:, swap], bsize[swap], np.full(swap.sum(), j + 1)))
                # of a run of equal letters the last one is left out
                rest = length[k] > j
                k, klow, ksize = k[rest], klow[:, rest], ksize[rest]
                cut = table[k, j] != table[k, np.minimum(j + 1, table.shape[1] - 1)]
                waiting.append((k[cut], klow[:, cut], ksize[cut], np.full(cut.sum(), j + 1)))
                held += 2 * len(i) + len(k)
                if held > FRONTIER:
                    finish()
            stay = length[q] > j
            q, low, size = q[stay], low[:, stay], size[stay]
            c = table[q, j]
            low, size = self.extend(side, low, size, c)
            stay = (size > 0) & (c > 0)
            q, low, size = q[stay], low[:, stay], size[stay]
        finish()
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *asked]), np.concatenate([none, *found])


def near_words(index: list[bytes], counts: np.ndarray, queries: list[bytes],
               side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of near words, place of the most frequent one or -1) of each query by one scheme,
    and the counts of that word."""
    half = np.array([len(w) // 2 for w in queries], np.int64)
    length = np.array([len(w) for w in queries], np.int64)
    q, word = BiIndex(index).one_error(queries, half if side else length - half, side)
    if not side:  # those with the first half whole are scheme one's
        keep = np.array([not index[w].startswith(queries[i][:len(queries[i]) // 2])
                         for i, w in zip(q.tolist(), word.tolist(), strict=True)], bool)
        q, word = q[keep], word[keep]
    best = np.full(len(queries), -1)
    order = np.lexsort((word, -counts[word], q))
    lead = order[np.append(True, q[order][1:] != q[order][:-1])] if len(q) else order
    best[q[lead]] = word[lead]
    return np.bincount(q, minlength=len(queries)), best, np.where(best >= 0, counts[best], 0)


def _sharded(vocabulary: DataFrame, shard_chars: int, min_length: int) -> DataFrame:
    """word, n, ask, held, side, bucket, tree, asker: where words ask and are indexed."""
    total = vocabulary.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    buckets = max(1, -(-6 * total // shard_chars))
    size = F.char_length("word")

    def places(side: int):
        def place(length):
            half = F.floor(length / 2).cast("int")
            piece = F.substring("word", F.lit(1), half) if side else F.right("word", length - half)
            bucket = F.pmod(F.xxhash64(length, piece), F.lit(buckets))
            return F.struct(F.lit(side).alias("side"), bucket.alias("bucket"), (length == size).alias("ask"))
        return F.transform(F.filter(F.array(size - 1, size, size + 1), lambda x: x >= min_length), place)

    rows = vocabulary.select("word", "n", F.explode(F.concat(places(1), places(0))).alias("at"))
    rows = (rows.groupBy("word", "n", F.col("at.side").alias("side"), F.col("at.bucket").alias("bucket"))
            .agg(F.max("at.ask").alias("ask")))
    rows = materialize(rows)
    hot = (rows.groupBy("side", "bucket").agg(F.sum(F.char_length("word") + 1).alias("chars"))
           .where(F.col("chars") > shard_chars)
           .select("side", "bucket", F.ceil(F.col("chars") / shard_chars).cast("long").alias("parts")))
    marked = rows.join(hot, ["side", "bucket"], "left")
    zero = F.lit(0).cast("long")
    plain = marked.where("parts is null").select("word", "n", "side", "bucket", zero.alias("tree"),
                                                 zero.alias("asker"), "ask", F.lit(True).alias("held"))
    every = F.sequence(zero, F.col("parts") - 1)
    cut = (marked.where("parts is not null").withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")))
           .withColumn("tree", F.explode(every))
           .withColumn("asker", F.explode(F.when(F.col("tree") == F.col("own"), every)
                                          .otherwise(F.array("own"))))
           .select("word", "n", "side", "bucket", "tree", "asker",
                   (F.col("ask") & (F.col("asker") == F.col("own"))).alias("ask"),
                   (F.col("tree") == F.col("own")).alias("held"))
           .where("ask or held"))
    return plain.unionByName(cut)


def _hits(sharded: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: what one shard knows of a word."""

    def run(group: pa.Table) -> pa.Table:
        side = group.column("side")[0].as_py()
        held = group.filter(group.column("held"))
        index = sorted(zip([w.encode("latin-1") for w in held.column("word").to_pylist()],
                           held.column("n").to_pylist(), strict=True))
        asking = group.filter(group.column("ask")).column("word")
        queries = [w.encode("latin-1") for w in asking.to_pylist()]
        words = [w for w, _ in index]
        if not words or not queries:
            return _HITS.empty_table()
        counts = np.array([n for _, n in index], np.int64)
        by = sorted(range(len(queries)), key=lambda i: len(queries[i]))
        near, best, best_n = near_words(words, counts, [queries[i] for i in by], side)
        found = np.flatnonzero(near)
        return pa.table([asking.take(pa.array(np.array(by, np.int64)[found])), pa.array(near[found], pa.int64()),
                         pa.array(best_n[found], pa.int64()),
                         pa.array([words[i].decode("latin-1") for i in best[found]], pa.string())], _HITS)

    return (sharded.groupBy("side", "bucket", "tree", "asker")
            .applyInArrow(run, "word string, n_near long, best_n long, best string"))


_HITS = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()),
                   ("best", pa.string())])


def _roots(links: DataFrame) -> DataFrame:
    """word, root of all words with a form. Counts grow by ``ratio`` along forms, so chains are
    short, and each round doubles the steps taken."""
    now = links.select("word", F.col("form").alias("root"))
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(now.join(up, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
             damage: int = DAMAGE, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """One row for each word of the vocabulary: word, form (its most frequent near word, the
    smallest of several, if that is at least ``ratio`` times as frequent; else null), root (the
    last of the forms that follow, itself without a form), n, n_near (number of words at edit
    distance one), form_n (the form's n or null)."""
    require(docs, id_col, text_col)
    if min_length < 2 or ratio < 2:
        raise ValueError("min_length and ratio must be at least 2")
    vocabulary = materialize(word_counts(docs, id_col, text_col, min_length, damage)
                             .where(F.col("n") >= min_count))
    hits = (_hits(_sharded(vocabulary, shard_chars, min_length)).groupBy("word")
            .agg(F.sum("n_near").alias("n_near"),
                 F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")))
    is_form = -F.col("top.less") >= ratio * F.col("n")
    rows = materialize(vocabulary.join(hits, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("top.best")).alias("form"),
        F.when(is_form, -F.col("top.less")).alias("form_n")))
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
