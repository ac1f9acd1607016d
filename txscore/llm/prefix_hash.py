"""Document fingerprints from prefix polynomial hashes.

A text's prefix arrays hold, for two bases, the sums of code point times base**position modulo
2**31 - 1. The hash of any span is the difference of two entries, shifted to
position zero, so spans of equal content have equal hashes wherever they lie: span
equality costs O(1), the longest common extension of two places a binary search.

The fingerprint of a text is the hash of the whole text and its length, then a sketch: the
hashes of all spans of ``SPAN`` code points (the whole text, if it is shorter) are dealt to
``BINS`` bins by their mixed upper bits, and each bin keeps eight bits of its smallest. Bins
without a span take over the next filled one's. The likeness of two fingerprints is one if
their whole-text hashes agree; else the share of equal bins estimates the
Jaccard coefficient J of the span sets (less what eight bits agree on by chance), and
the likeness is 2J / (1 + J), the share of spans in common.

Null text counts as empty; an empty text is like other empty texts only. Repeated rows have
equal fingerprints; those of one id follow one another, and each is hashed once.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import partitions, require, slices

PRIME = np.uint64((1 << 31) - 1)
SHIFT = np.uint64(31)
BASES = (1_103_515_245, 1_566_083_941)
SPAN = 24
BINS = 128
EMPTY = np.uint64((1 << 64) - 1)
#: Buckets of neighbouring ids for each shuffle partition.
BUCKETS_PER_PARTITION = 4


def fold(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME for x < 2**62, where PRIME itself may stand for zero; changes x."""
    high = x >> SHIFT
    x &= PRIME
    x += high
    np.right_shift(x, SHIFT, out=high)
    x &= PRIME
    x += high
    return x


class Powers:
    """base**i and base**-i modulo PRIME, grown on demand."""

    def __init__(self) -> None:
        self.size = 0

    def grow(self, n: int) -> None:
        if n <= self.size:
            return
        self.size = max(n, 2 * self.size, 1 << 12)
        p = int(PRIME)
        self.up = [self._row(b, self.size) for b in BASES]
        self.down = [self._row(pow(b, -1, p), self.size) for b in BASES]

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, fold(out * np.uint64(pow(base, len(out), int(PRIME))))])
        return out[:n]


POWERS = Powers()


class PrefixHash:
    """Prefix arrays of a text; ``start`` gives those of a text with the same beginning."""

    def __init__(self, text: str, start: tuple[PrefixHash, int] | None = None):
        self.n = len(text)
        POWERS.grow(self.n + 1)
        same = start[1] if start else 0
        points = np.frombuffer(text[same:].encode("utf-32-le", "surrogatepass"), np.uint32)
        points = points.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for k, up in enumerate(POWERS.up):
            terms = fold(points * up[same:self.n])
            head = start[0].sums[k][:same + 1] if start else np.zeros(1, np.uint64)
            # sums of fewer than 2**31 terms stay below 2**62
            self.sums.append(np.concatenate([head, fold(np.cumsum(terms) + head[-1])]))

    def spans(self, first: int, last: int, length: int) -> np.ndarray:
        """62-bit hashes of the spans [i, i + length) for first <= i < last."""
        out = np.zeros(max(last - first, 0), np.uint64)
        if last > first:
            for s, down in zip(self.sums, POWERS.down, strict=True):
                gap = s[first + length:last + length] + PRIME - s[first:last]
                h = fold(fold(gap) * down[first:last])
                h[h == PRIME] = 0
                out = (out << SHIFT) | h
        return out

    def span(self, i: int, j: int) -> int:
        """62-bit hash of the span [i, j)."""
        out, p = 0, int(PRIME)
        for s, down in zip(self.sums, POWERS.down, strict=True):
            out = out << 31 | (int(s[j]) - int(s[i])) * int(down[i]) % p
        return out

    def extension(self, i: int, other: PrefixHash, j: int) -> int:
        """Length of the longest common extension of place i here and place j of the other."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(i, i + mid) == other.span(j, j + mid):
                low = mid
            else:
                high = mid - 1
        return low


def smallest(hashes: np.ndarray) -> np.ndarray:
    """Smallest mixed hash in each bin."""
    out = np.full(BINS, EMPTY)
    h = hashes * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    np.minimum.at(out, (h >> np.uint64(57)).astype(np.int64), h)
    return out


def sketch(bins: np.ndarray) -> bytes:
    filled = np.flatnonzero(bins != EMPTY)
    if not len(filled):
        return bytes(BINS)
    source = filled[np.searchsorted(filled, np.arange(BINS)) % len(filled)]
    distance = (source - np.arange(BINS)) % BINS
    values = bins[source] + distance.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((values ^ (values >> np.uint64(24))) & np.uint64(255)).astype(np.uint8).tobytes()


class Fingerprinted:
    """A text with its prefix arrays, whole-text hash and sketch."""

    def __init__(self, doc_id, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.hash = PrefixHash(self.text)
        self.bins = smallest(self.hash.spans(*self._range(self.hash)))
        self.finger = self._finger(self.hash, self.bins)

    def copy(self, doc_id) -> Fingerprinted:
        """The same text under another id."""
        other = copy.copy(self)
        other.doc_id = doc_id
        return other

    @staticmethod
    def _range(h: PrefixHash) -> tuple[int, int, int]:
        length = min(SPAN, h.n)
        return 0, h.n - length + 1 if h.n else 0, length

    @staticmethod
    def _finger(h: PrefixHash, bins: np.ndarray) -> str:
        whole = h.span(0, h.n) if h.n else 0
        return f"{h.n:016x}{whole:016x}" + sketch(bins).hex()

    def edited(self, other: str) -> tuple[str, str, int]:
        """The text with its last third replaced from ``other``, its fingerprint, and the
        common prefix with this text. Prefix arrays and spans of the first part are shared."""
        cut = self.hash.n // 3
        same = self.hash.n - cut
        text = self.text[:same] + other[:cut]
        h = PrefixHash(text, (self.hash, same))
        if same >= SPAN:
            bins = np.minimum(smallest(self.hash.spans(0, same - SPAN + 1, SPAN)),
                              smallest(h.spans(same - SPAN + 1, h.n - SPAN + 1, SPAN)))
        else:
            bins = smallest(h.spans(*self._range(h)))
        return text, self._finger(h, bins), self.hash.extension(0, h, 0)


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, from 0 to 1."""
    if a[:32] == b[:32]:
        return 1.0
    if int(a[:16], 16) == 0 or int(b[:16], 16) == 0:
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(f[32:]), np.uint8) for f in (a, b))
    share = float((x == y).mean())
    jaccard = max(0.0, (share - 1 / 256) / (1 - 1 / 256))
    return 2 * jaccard / (1 + jaccard)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint of every row."""
    require(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [Fingerprinted(None, t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([f.hash.n for f in found], pa.int64()),
                 pa.array([f.finger for f in found], pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string")


def _in_order(docs: DataFrame, per_partition: int = BUCKETS_PER_PARTITION) -> DataFrame:
    """Rows by descending (doc_id, hash of the text), nulls last, dealt to buckets of neighbouring
    rows; each bucket ends with a ``guest``, the first row of the bucket after it. An id with
    more rows than a bucket should hold (or the null id) has buckets of its own, cut by the
    range of the text's hash; only ids beyond 2**53 may share a bucket that isn't cut. Texts move
    once; before that, only ids and, for such hot ids, hashes are read to find the buckets."""
    spark = docs.sparkSession
    n = partitions(spark) * per_partition
    edges = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n)))
    own = F.lit(0)
    if edges:
        splits = [-math.inf, *edges, math.inf]
        docs = Bucketizer(splits=splits, inputCol="place_of", outputCol="place",
                          handleInvalid="keep").transform(
            docs.withColumn("place_of", F.col("doc_id").cast("double")))
        place = F.col("place").cast("int")
        # every frequent id is an edge; the ids above it have a bucket apart
        edge = F.element_at(F.array(*map(F.lit, splits)), place + 1)
        own = place * 2 + (F.col("place_of") > edge).cast("int")
    docs = docs.select("doc_id", "text", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(own).alias("b"))
    heads = (docs.groupBy("b").agg(F.max("doc_id").alias("top"), F.min("doc_id").alias("low"),
                                   F.count("*").alias("n")).collect())  # at most two for each edge
    if not heads:
        return docs.select("doc_id", "text", F.lit(0).alias("bucket"), F.lit(False).alias("guest"),
                           F.lit(0).cast("long").alias("th"))
    share = max(1, sum(r.n for r in heads) // n)
    cuts = {r.b: -(-r.n // share) for r in heads if r.top == r.low and r.n > 2 * share}
    filled = [(r.b, 0, r.top, None) for r in heads if r.b not in cuts]
    rows = docs.withColumn("th", F.coalesce(F.xxhash64("text"), F.lit(0)))
    if cuts:
        pieces = F.broadcast(spark.createDataFrame(list(cuts.items()), "b int, pieces long"))
        # the hash's upper 32 bits as a share of 2**32: hashes ascend with the cut
        cut = F.shiftright((F.shiftright("th", 32) + F.lit(1 << 31)) * F.col("pieces"), 32)
        rows = (rows.join(pieces, "b", "left")
                .withColumn("cut", F.coalesce(cut, F.lit(0)).cast("int")).drop("pieces"))
        tops = (rows.where(F.col("b").isin(*cuts)).groupBy("b", "cut", "doc_id")
                .agg(F.max("th").alias("th")).collect())  # at most three for each bucket wanted
        filled += [(r.b, r.cut, r.doc_id, r.th) for r in tops]
    else:
        rows = rows.withColumn("cut", F.lit(0))
    filled.sort(key=lambda x: x[:2])
    number = F.broadcast(spark.createDataFrame(
        [(b, cut, i) for i, (b, cut, *_) in enumerate(filled)], "b int, cut int, bucket int"))
    goes_to = F.broadcast(spark.createDataFrame(
        [(top, th, (i + 1) % len(filled)) for i, (_, _, top, th) in enumerate(filled)],
        "top long, top_th long, guest_of int"))
    own_rows = rows.join(number, ["b", "cut"]).select("doc_id", "text", "bucket", F.lit(False).alias("guest"), "th")
    first = (rows.join(goes_to, F.col("doc_id").eqNullSafe(F.col("top"))
                       & (F.col("top_th").isNull() | (F.col("th") == F.col("top_th"))))
             .groupBy("guest_of", "doc_id").agg(F.max(F.struct("th", "text")).alias("head"))
             .select("doc_id", "head.text", F.col("guest_of").alias("bucket"), F.lit(True).alias("guest"), "head.th"))
    return (own_rows.unionByName(first).repartition(partitions(spark), "bucket")
            .sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), F.desc("th")))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row, by descending id (after the last row comes the first): doc_id, n_chars,
    fingerprint, edited (the text whose last third is replaced by the beginning of the
    next row's), edited_fingerprint, near_edited, near_next (likeness to the edited text and to
    the next row) and common_prefix (of text and edited text, by binary search)."""
    require(docs, id_col, text_col)
    rows = _in_order(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                 F.col(text_col).cast("string").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "fingerprint", "edited", "edited_fingerprint", "near_edited",
                 "near_next", "common_prefix"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                 pa.float64(), pa.int64()]
        last, now, done = None, None, None
        for part in slices(batches, "text"):
            out = []
            for doc_id, text, bucket in zip(*(part.column(c).to_pylist() for c in (
                    "doc_id", "text", "bucket")), strict=True):
                same = last is not None and last.text == (text or "")
                doc = last.copy(doc_id) if same else Fingerprinted(doc_id, text)
                if last is not None and bucket == now:
                    if not same or done is None:
                        edited, finger, prefix = last.edited(doc.text)
                        done = (last.hash.n, last.finger, edited, finger,
                                likeness(last.finger, finger), likeness(last.finger, doc.finger), prefix)
                    out.append((last.doc_id, *done))
                if not same or bucket != now:
                    done = None
                last, now = doc, bucket
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint string, edited string, "
                                "edited_fingerprint string, near_edited double, near_next double, "
                                "common_prefix long")

