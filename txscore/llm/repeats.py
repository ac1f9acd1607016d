"""Removal of long repeated byte strings with a sparse enhanced suffix array.

Every byte covered by a string of ``min_bytes`` bytes that also starts elsewhere (in any
document, the same one included) is removed. Matches never cross documents.

1. Anchors. Each window of ``min_bytes`` bytes picks its smallest ``gram``-byte hash
   (leftmost of equals), so equal windows pick the same place in them. Windows of a
   document that pick the same anchor form a fragment: every window lies in exactly one.
2. Classes. Fragments are grouped by anchor hash, and in it by content. Fragments with an
   equal one elsewhere are repeats as a whole. One fragment for each content goes on, and only
   where an anchor has several. Groups stay small: a content that a task meets more than once
   in a batch is handed on twice there and no more after (further occurrences are known
   repeats, merged to ranges of their document), and the rows of an anchor with more than
   ``hot_classes`` rows, found by a counting pass, are dealt by content.
3. Suffix array. The suffixes that start at the anchors of one anchor hash are sorted,
   with the lengths of their common prefixes. A stack scan yields the tree of common-
   prefix intervals. In every interval the texts before the anchors are sorted the same
   way from right to left: each interval of *these* whose members differ in the byte
   before them (left diversity), and that come from more than one child interval (right
   diversity), is a maximal repeat through this anchor, with all its occurrences.
   Repeats of at least ``min_bytes`` bytes are kept.
4. The contents of those hot anchors are not sorted in one task: their
   windows are hashed and counted across the cluster, which is exact as well.

Fragments hold whole windows, so occurrences are cut to them; the removed runs of a
document are the union over its fragments. Work before step 3 follows the corpus
at about one row for every ``(min_bytes - gram) / 2`` bytes.

Null text counts as empty; texts under ``min_bytes`` bytes keep all. Repeated rows are
copies of one another. A null id is carried along. Texts of any length are processed
whole, in steps of ``STEP`` windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.llm.common import require, slices, span_lists
from txscore.session import materialize

MIN_BYTES = 200
GRAM = 48
#: Windows processed at once; a text of more windows is processed in steps.
STEP = 1 << 20
#: Fragments of one anchor hash that a task groups and sorts.
HOT_CLASSES = 20_000
#: Contents that a task remembers as handed on twice in a batch; a full table starts anew.
KNOWN_CONTENTS = 1 << 17
#: ``classes`` of a hot anchor.
HOT = 1 << 40
#: Bytes of fragments that a task gathers before it works on them.
GROUP_BYTES = 4 << 20

FRAGMENT = ("h long, c long, id0 long, th long, lo int, n int, a int, multi boolean, "
            "direct boolean")
SPAN = "array<struct<start:long,end:long>>"


class Anchors:
    """Fragments of texts. Gram hashes are polynomials modulo 2**64 over random byte values."""

    def __init__(self, min_bytes: int = MIN_BYTES, gram: int = GRAM, step: int = STEP):
        self.min, self.gram, self.step = min_bytes, min(gram, min_bytes), step
        rng = np.random.default_rng(20)
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        base = np.uint64(0x9E3779B97F4A7C15)
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def cut(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor hash, first byte, length, anchor's place in the fragment) arrays, by step."""
        for start in range(0, len(data) - self.min + 1, self.step):
            part = np.frombuffer(data, np.uint8, min(self.step + self.min - 1, len(data) - start), start)
            n, k = len(part), self.gram
            self.powers(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.value[part] * self.up[:n], out=sums[1:])
            h = (sums[k:] - sums[:-k]) * self.down[:n - k + 1]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            bits = np.uint64((1 << 21) - 1)
            least = (h & ~bits) | np.arange(len(h), dtype=np.uint64)
            width, span = self.min - k + 1, 1
            while span * 2 <= width:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            windows = n - self.min + 1
            least = np.minimum(least[:windows], least[width - span:width - span + windows])
            at = (least & bits).astype(np.int64)
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            last = np.append(first[1:], windows) - 1
            at = at[first]
            yield h[at].view(np.int64), first + start, last - first + self.min, at - first


def common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    m = min(len(x), len(y))
    if x[:m] == y[:m]:
        return m
    odd = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
    return m - (odd.bit_length() + 7) // 8


def intervals(prefix: list[int]) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the common-prefix intervals of a sorted list, children first;
    ``prefix[i]`` is the common prefix of members i and i + 1."""
    stack: list[tuple[int, int]] = []  # (length, first)
    for i, p in enumerate([*prefix, -1]):
        first = i
        while stack and stack[-1][0] > p:
            length, first = stack.pop()
            yield length, first, i
        if p >= 0 and (not stack or stack[-1][0] < p):
            stack.append((p, first))


def maximal_repeats(before: list[bytes], after: list[bytes],
                    least: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members): maximal repeats of at least ``least`` bytes through an anchor.

    ``before[i]`` is the text before anchor i reversed, ``after[i]`` the text from it on;
    members share ``left`` bytes before and ``right`` bytes from the anchor on."""
    order = sorted(range(len(after)), key=after.__getitem__)
    prefix = [common(after[i], after[j]) for i, j in zip(order[:-1], order[1:], strict=True)]
    longest = max(map(len, before))
    for right, first, last in intervals(prefix):
        if right + longest < least:
            continue
        # child intervals are separated where the common prefix is just ``right``
        child, number = {}, 0
        for i in range(first, last + 1):
            child[order[i]] = number
            number += i < last and prefix[i] == right
        inner = sorted(order[first:last + 1], key=before.__getitem__)
        left_of = [common(before[i], before[j]) for i, j in zip(inner[:-1], inner[1:], strict=True)]
        for left, a, b in intervals(left_of):
            if left + right >= least:
                members = inner[a:b + 1]
                if len({child[m] for m in members}) > 1:
                    yield left, right, members


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text as UTF-8 bytes, and a key (id0, th) that only rows with the same id and
    text share; ``carried``: further columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    more = [F.struct(*carry).alias("carried")] if carry else []
    return docs.select(*more, F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("data"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id0"),
                       F.xxhash64(text).alias("th"))


def settle(columns: list[np.ndarray], row: np.ndarray,
           known: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of a batch of fragments (``row``: their text) where occurrences of ``known`` contents,
    and those after the second in the batch, are ranges that need no comparison any more;
    and the contents known from now on, sorted."""
    h, c, id0, th, lo, n, a, multi, direct = columns
    open_ = np.flatnonzero(~direct)
    order = open_[np.argsort(c[open_], kind="stable")]
    new = np.append(True, c[order][1:] != c[order][:-1]) if len(order) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    place = np.arange(len(order)) - first
    at = np.minimum(np.searchsorted(known, c[order]), max(len(known) - 1, 0))
    held = known[at] == c[order] if len(known) else np.zeros(len(order), bool)
    sure = direct.copy()
    sure[order[held | (place > 1)]] = True
    met = c[order[(place == 1) & ~held]]
    known = np.union1d(known, met) if len(known) + len(met) <= KNOWN_CONTENTS else np.unique(met)
    ranges = np.flatnonzero(sure)
    ranges = ranges[np.lexsort((lo[ranges], row[ranges]))]
    out = [x[~sure] for x in columns]
    if len(ranges):
        base = row[ranges].astype(np.int64) << 32
        start, end = base + lo[ranges], np.maximum.accumulate(base + lo[ranges] + n[ranges])
        fresh = np.append(True, (start[1:] > end[:-1]) | (row[ranges][1:] != row[ranges][:-1]))
        heads = np.flatnonzero(fresh)
        keep, last = ranges[heads], np.append(heads[1:], len(ranges)) - 1
        # a hash of its own for each, so that no group of them is large
        spread = th[keep] ^ (lo[keep].astype(np.int64) * np.int64(0x5851F42D4C957F2D))
        size, k = (end[last] - start[heads]).astype(np.int32), len(keep)
        more = [spread, c[keep], id0[keep], th[keep], lo[keep], size, np.zeros(k, np.int32),
                np.ones(k, bool), np.ones(k, bool)]
        out = [np.concatenate(x) for x in zip(out, more, strict=True)]
    return out, known


def fragments(keyed: DataFrame, min_bytes: int, gram: int, step: int = STEP) -> DataFrame:
    """One row for each different fragment of a document (``multi``: it occurs there more than
    once), and ``direct`` rows for merged ranges of known repeats: further occurrences in the
    document, and those of contents that the task has handed on twice in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest, anchors = xxhash.xxh64_intdigest, Anchors(min_bytes, gram, step)
        known = np.zeros(0, np.int64)
        for part in slices(batches, "data"):
            found: list[tuple[np.ndarray, ...]] = []
            for id0, th, data in zip(*(part.column(x).to_pylist() for x in ("id0", "th", "data")),
                                     strict=True):
                for h, lo, n, a in anchors.cut(data):
                    c = np.array([digest(data[i:i + m]) for i, m in zip(lo.tolist(), n.tolist(),
                                                                        strict=True)], np.uint64)
                    _, first, times = np.unique(c, return_index=True, return_counts=True)
                    multi, rest = np.zeros(len(c), bool), np.ones(len(c), bool)
                    multi[first], rest[first] = times > 1, False
                    direct = np.zeros(len(c), bool)
                    if rest.any():
                        more = merge(list(zip(lo[rest].tolist(), (lo + n)[rest].tolist(), strict=True)))
                        h, c, a, multi = h[first], c[first], a[first], multi[first]
                        lo = np.concatenate([lo[first], [x for x, _ in more]])
                        n = np.concatenate([n[first], [y - x for x, y in more]])
                        k = len(more)
                        h, c = np.append(h, h[:1].repeat(k) + lo[-k:]), np.append(c, c[:1].repeat(k))
                        a, multi = np.append(a, [0] * k), np.append(multi, [True] * k)
                        direct = np.arange(len(lo)) >= len(first)
                    m = len(lo)
                    found.append((h, c.view(np.int64), np.full(m, id0), np.full(m, th),
                                  lo.astype(np.int32), n.astype(np.int32), a.astype(np.int32),
                                  multi, direct))
            if found:
                row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                columns, known = settle([np.concatenate(x) for x in zip(*found, strict=True)], row, known)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns],
                    ["h", "c", "id0", "th", "lo", "n", "a", "multi", "direct"])

    return keyed.select("id0", "th", "data").mapInArrow(run, FRAGMENT)


def classify(found: DataFrame, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """Rows with ``whole`` (the fragment is a repeat as a whole) and those with ``open`` (they go
    to the suffix array); ``classes``: contents of the anchor hash, ``HOT`` for a hot one."""
    hot = materialize(found.where("not direct").groupBy("h").count()
                      .where(F.col("count") > hot_classes).select("h", F.lit(True).alias("hot")))
    n = hot.count()
    is_hot, keys = F.lit(False), ["h"]
    if n:  # at most one anchor for each ``hot_classes`` fragments; sent to all tasks up to 16 MB
        found = found.join(F.broadcast(hot) if n <= 1_000_000 else hot, "h", "left")
        is_hot, keys = F.coalesce("hot", F.lit(False)), ["h", "part"]
        found = found.withColumn("part", F.when(is_hot, F.col("c")).otherwise(F.lit(0)))
    by_h, by_c = Window.partitionBy(*keys), Window.partitionBy(*keys, "c")
    row = by_c.orderBy("direct", "id0", "th", "lo")
    # one exchange by anchor hash serves all windows, those by content too
    return (found.repartition(*keys).withColumn("rn", F.row_number().over(row))
            .withColumn("n_hc", F.count("*").over(by_c))
            .withColumn("whole", F.col("multi") | (F.col("n_hc") > 1))
            .withColumn("classes", F.when(is_hot, F.lit(HOT)).otherwise(
                F.sum((F.col("rn") == 1).cast("long")).over(by_h)))
            .withColumn("undecided", is_hot | F.max(~F.col("whole")).over(by_h))
            .withColumn("open", (F.col("rn") == 1) & ~F.col("direct") & (F.col("classes") > 1)
                        & F.col("undecided"))
            .where("whole or open")
            .select("h", "id0", "th", "lo", "n", "a", "whole", "open", "classes"))


def _resolve(group: list[tuple], least: int) -> Iterator[tuple[int, int, int, int]]:
    """(id0, th, lo, hi) of the repeats in one anchor's fragments that aren't whole repeats."""
    before = [data[:a][::-1] for _, _, _, a, _, data in group]
    after = [data[a:] for _, _, _, a, _, data in group]
    ranges: dict[int, list[tuple[int, int]]] = {}
    for left, right, members in maximal_repeats(before, after, least):
        for m in members:
            if not group[m][4]:
                start = group[m][2] + group[m][3]
                ranges.setdefault(m, []).append((start - left, start + right))
    for m, r in ranges.items():
        for lo, hi in merge(r):
            yield group[m][0], group[m][1], lo, hi


def suffix_ranges(contents: DataFrame, min_bytes: int) -> DataFrame:
    """(id0, th, lo, hi) of repeats found by the suffix arrays of the anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(rows: list[tuple]) -> pa.RecordBatch:
            out = list(zip(*rows, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())],
                ["id0", "th", "lo", "hi"])

        now, group, rows = None, [], []
        for part in slices(batches, "data", GROUP_BYTES):
            for h, *member in zip(*(part.column(x).to_pylist() for x in (
                    "h", "id0", "th", "lo", "a", "whole", "data")), strict=True):
                if h != now:
                    if len(group) > 1:
                        rows += _resolve(group, min_bytes)
                    now, group = h, []
                group.append(tuple(member))
            yield answer(rows)
            rows = []
        if len(group) > 1:
            rows += _resolve(group, min_bytes)
        yield answer(rows)

    return (contents.repartition("h").sortWithinPartitions("h", "id0", "th", "lo")
            .mapInArrow(run, "id0 long, th long, lo int, hi int"))


def hot_ranges(contents: DataFrame, min_bytes: int) -> DataFrame:
    """(id0, th, lo, hi) of repeated windows of hot anchors, by counting their digests."""
    windows = contents.select("id0", "th", "lo", "whole", "data", F.explode(F.sequence(
        F.lit(0), F.col("n") - min_bytes)).alias("s"))
    windows = windows.select("id0", "th", "whole", (F.col("lo") + F.col("s")).alias("lo"),
                             F.md5(F.expr(f"substring(data, s + 1, {min_bytes})")).alias("w"))
    again = windows.groupBy("w").count().where("count > 1").select("w")
    return (windows.where("not whole").join(again, "w")
            .select("id0", "th", "lo", (F.col("lo") + min_bytes).alias("hi")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_bytes: int = MIN_BYTES, gram: int = GRAM,
                   hot_classes: int = HOT_CLASSES, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, spans (removed byte ranges, maximal and
    in order), kept (the remaining bytes) and text (kept as text, without characters that a
    cut left incomplete); with ``carry``, also a struct ``carried`` of these columns of the row."""
    require(docs, id_col, text_col, *carry)
    keyed = _keyed(docs, id_col, text_col, carry)
    marks = materialize(classify(fragments(keyed, min_bytes, gram), hot_classes))
    wanted = (marks.where("open").groupBy("id0", "th").agg(F.collect_set(F.struct(
        "h", "lo", "n", "a", "whole", "classes")).alias("f")))
    texts = keyed.select("id0", "th", "data").join(wanted, ["id0", "th"])
    contents = texts.select("id0", "th", F.explode(F.transform("f", lambda f: F.struct(
        f.h.alias("h"), f.lo.alias("lo"), f.n.alias("n"), f.a.alias("a"), f.whole.alias("whole"),
        f.classes.alias("classes"),
        F.substring(F.col("data"), f.lo + 1, f.n).alias("data")))).alias("f")).select("id0", "th", "f.*")
    found = marks.where("whole").select("id0", "th", "lo", (F.col("lo") + F.col("n")).alias("hi"))
    found = found.unionByName(suffix_ranges(contents.where(F.col("classes") <= hot_classes), min_bytes))
    if marks.where("open").where(F.col("classes") > hot_classes).limit(1).count():
        found = found.unionByName(hot_ranges(contents.where(F.col("classes") > hot_classes), min_bytes))
    spans = found.groupBy("id0", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    more = ["carried"] if carry else []
    rows = keyed.join(spans, ["id0", "th"], "left").select("doc_id", "data", "ranges", *more)
    schema = f"doc_id long, n_bytes long, spans {SPAN}, kept binary, text string"
    if carry:
        schema += f", carried {keyed.schema['carried'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "data"):
            data = part.column("data").to_pylist()
            cut = [merge([(r["lo"], r["hi"]) for r in ranges or ()])
                   for ranges in part.column("ranges").to_pylist()]
            kept = []
            for text, gone in zip(data, cut, strict=True):
                ends = [0, *(x for r in gone for x in r), len(text)]
                kept.append(b"".join(text[i:j] for i, j in zip(ends[::2], ends[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(x) for x in data], pa.int64()), span_lists(cut),
                 pa.array(kept, pa.binary()), pa.array([x.decode("utf-8", "ignore") for x in kept]),
                 *(part.column(c) for c in more)],
                ["doc_id", "n_bytes", "spans", "kept", "text", *more])

    return rows.mapInArrow(run, schema)
