"""Token counts of whole documents by overlap resynchronisation.

Texts of up to ``chunk`` code points are encoded by one call of the library. A longer text is cut
into chunks that reach ``overlap`` code points over each seam on both sides; chunks are rows of
their own, so the tasks share the work on one huge document. Each chunk is encoded alone, and
every token has its end as an offset in the document.

Splicing. At a seam, the left chunk's tokens and the right chunk's tokens both cover the overlap.
A token that both have (the same piece with the same end) is a proven stable boundary: merges of
a BPE model are ordered by (score, place), so a row of tokens is the encoding of its text exactly
if each two neighbours are the encoding of theirs. Left of the common token all neighbours come
from the left chunk, right of it all from the right chunk, and the token itself has its left
neighbour in one and its right neighbour in the other. The spliced tokens therefore are those of
the whole text, and the count of a document is the sum over its chunks less what is dropped at
the seams: the left chunk's tokens after the boundary and the right chunk's up to it.

If the overlap has no common token (a long row of equal characters can be cut in step with no
other), it is widened to both whole chunks: these are joined and encoded anew, round by round
until every seam is spliced. At the worst a document is one chunk again, which is the library's
own call.

Null text counts as empty (no tokens). A null id is carried along; repeated rows are counted each;
an empty table gives an empty result. Columns other than the id and the text aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import partitions, require, slices
from txscore.session import materialize

#: Code points of a chunk, and how far it reaches over a seam on either side.
CHUNK, OVERLAP = 1 << 16, 256
LIMIT_TOKENS = 4096
SPACE = "▁"
#: Row keys: partition number times this, plus a count in the partition.
STRIDE = 1 << 40
CHUNKS = "key long, part long, head string, core string, tail string"
PIECES = "key long, part long, n long, first binary, last binary"


class Pieces:
    """A sentencepiece BPE model with the number of code points of its pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.sp = sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        scores = [sp.get_score(i) for i in range(size)
                  if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))]
        # trained BPE models score a piece by its (whole) place in the order of merges
        if any(s != int(s) or s > 0 for s in scores):
            raise ValueError("the model is not a BPE model")
        # bytes of each piece; a space counts one, as in the text
        self.width = np.array([1 if sp.is_byte(i) else len(sp.id_to_piece(i).replace(SPACE, " ").encode())
                               for i in range(size)], np.int64)

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(len, self.sp.encode(texts, num_threads=1)))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the end of each as an offset in the UTF-8 bytes of ``text`` (in which the
        sign of a space counts as one). The dummy prefix is the byte before the text."""
        ids = np.array(self.sp.encode(text), np.int64)
        ends = np.cumsum(self.width[ids]) - 1
        if len(ids) and ends[-1] != width(text):
            raise ValueError("the model normalises texts; offsets don't hold")
        return ids, ends


def width(text: str) -> int:
    return len(text.replace(SPACE, " ").encode())


def plan(n: int, chunk: int) -> list[tuple[int, int]]:
    """(start, end) of the chunks of a text of ``n`` code points, of about equal size."""
    k = max(1, -(-n // chunk))
    edges = [n * i // k for i in range(k + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def near_seam(ids: np.ndarray, ends: np.ndarray, low: int, high: int, base: int, before: int) -> bytes:
    """The tokens that end within (low, high] as a flat array: how many tokens stand before
    them, then id and end (counted from ``base``) of each."""
    at = slice(*np.searchsorted(ends, [low, high], side="right"))
    own = np.stack([ids[at], ends[at] - base], axis=1).ravel()
    return np.concatenate([[before + at.start], own]).astype(np.int64).tobytes()


def drop_at_seam(left: bytes, right: bytes, left_n: int) -> int | None:
    """Tokens that go where two chunks meet: the left one's after the first common token and the
    right one's up to it; None without a common token."""
    a, b = np.frombuffer(left, np.int64), np.frombuffer(right, np.int64)
    pairs = [x[1:].reshape(-1, 2) for x in (a, b)]
    keys = [p[:, 1] * (1 << 24) + p[:, 0] for p in pairs]
    i, j = np.intersect1d(keys[0], keys[1], return_indices=True)[1:]
    if not len(i):
        return None
    return int(left_n - (a[0] + i[0] + 1) + b[0] + j[0] + 1)


def _chunk_rows(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """key, part, head, core, tail of every chunk of long texts, with id and size on part 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() * STRIDE
        for batch in slices(batches, "text"):
            for doc_id, n_bytes, text in zip(*(batch.column(c).to_pylist() for c in (
                    "doc_id", "n_bytes", "text")), strict=True):
                spans = plan(len(text), chunk)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": [doc_id] * len(spans), "n_bytes": [n_bytes] * len(spans),
                    "key": [key] * len(spans), "part": list(range(len(spans))),
                    "head": [text[max(0, a - overlap):a] for a, _ in spans],
                    "core": [text[a:b] for a, b in spans],
                    "tail": [text[b:b + overlap] for _, b in spans]}, _CHUNK_SCHEMA)
                key += 1

    return rows.mapInArrow(run, f"doc_id long, n_bytes long, {CHUNKS}")


_CHUNK_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("key", pa.int64()),
                           ("part", pa.int64()), ("head", pa.string()), ("core", pa.string()),
                           ("tail", pa.string())])


def _encoded(chunks: DataFrame, model: str) -> DataFrame:
    """key, part, n (tokens of head, core and tail), first and last (tokens near both seams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in slices(batches, "core"):
            out = []
            for row in batch.to_pylist():
                head, core, tail = row["head"], row["core"], row["tail"]
                # a space before the chunk is the dummy prefix itself
                text, at = (head[1:], 1) if head[:1] in (" ", SPACE) else (head, 0)
                ids, ends = pieces.encode(text + core + tail)
                ends = ends + at
                seam, size = width(head), width(head + core)
                reach, whole = width(core[:len(head)]), width(head + core + tail)
                out.append((row["key"], row["part"], len(ids),
                            near_seam(ids, ends, 0, seam + reach, seam, 0),
                            near_seam(ids, ends, size - width(core[len(core) - len(tail):]), whole, size, 0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECE_TYPES, strict=True)],
                ["key", "part", "n", "first", "last"])

    return chunks.mapInArrow(run, PIECES)


_PIECE_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())


def _seams(encoded: DataFrame) -> DataFrame:
    """key, part (of the right chunk), gone (tokens dropped there; null if nothing aligns)."""
    left = encoded.select("key", (F.col("part") + 1).alias("part"), F.col("n").alias("left_n"),
                          F.col("last").alias("left"))
    right = encoded.where("part > 0").select("key", "part", F.col("first").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = [drop_at_seam(r["left"], r["right"], r["left_n"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("part"), pa.array(gone, pa.int64())],
                ["key", "part", "gone"])

    return left.join(right, ["key", "part"]).mapInArrow(run, "key long, part long, gone long")


def _joined(chunks: DataFrame, seams: DataFrame) -> DataFrame:
    """Chunks with those on both sides of a failed seam joined, numbered anew."""
    from pyspark.sql import Window

    order = Window.partitionBy("key").orderBy("part")
    failed = seams.where("gone is null").select("key", "part", F.lit(0).alias("opens"))
    marked = (chunks.join(failed, ["key", "part"], "left")
              .withColumn("group", F.sum(F.coalesce("opens", F.lit(1))).over(order) - 1))
    parts = F.sort_array(F.collect_list(F.struct("part", "head", "core", "tail")))
    return (marked.groupBy("key", "group").agg(parts.alias("p"))
            .select("key", F.col("group").alias("part"), F.col("p")[0]["head"].alias("head"),
                    F.array_join(F.col("p.core"), "").alias("core"),
                    F.element_at("p", -1)["tail"].alias("tail")))


def _long_counts(chunks: DataFrame, model: str) -> DataFrame:
    """key, n_tokens of every long text."""
    while True:
        encoded = materialize(_encoded(chunks, model))
        seams = materialize(_seams(encoded))
        if seams.where("gone is null").isEmpty():
            break
        chunks = materialize(_joined(chunks, seams).repartition(partitions(chunks.sparkSession), "key", "part"))
    parts = encoded.select("key", "n").unionByName(seams.select("key", (-F.col("gone")).alias("n")))
    return parts.groupBy("key").agg(F.sum("n").alias("n_tokens"))


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT_TOKENS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than
    ``limit`` tokens)."""
    require(docs, id_col, text_col)
    if not 0 < 2 * overlap <= chunk // 2:
        raise ValueError("the overlaps of a chunk must be at most half of it")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in slices(batches, "text"):
            n = pieces.counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    size = F.char_length("text")
    short = rows.where(size <= chunk).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    # written once, so that the keys of the rows hold whatever is computed again
    cut = materialize(_chunk_rows(rows.where(size > chunk), chunk, overlap)
                      .repartition(partitions(docs.sparkSession), "key", "part"))
    found = _long_counts(cut.select("key", "part", "head", "core", "tail"), model)
    long = (cut.where("part = 0").select("key", "doc_id", "n_bytes").join(found, "key")
            .select("doc_id", "n_bytes", "n_tokens"))
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
