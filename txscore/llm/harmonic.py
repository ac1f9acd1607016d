"""Harmonic packing of token sequences into fixed-length training sequences.

A document is its token ids plus one end id. Whole runs of ``capacity`` ids are
sequences of their own. The rest of a document goes to a reciprocal-capacity
class: class ``k`` takes pieces of at most ``capacity // k`` ids, and each of its
bins holds exactly ``k`` of them. A rest that would leave much of its class's
share empty is first cut: its front becomes a piece that fills a share of the
next class exactly, and the remainder is classified anew.

Workers fill bins independently: a partition of the input is packed while it is
read, without a shuffle. It holds at most one open bin for each class (about
``2 * sqrt(capacity)`` classes). At the end of a partition the pieces of open bins are
laid end to end and cut into full sequences; what is left over goes into sequences
whose lengths are powers of two, which need no padding.

Null text counts as empty (one end id). Repeated rows are packed as often as they
occur. A null id is carried along as null. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import require, slices

CAPACITY = 2048
END_ID = 1
#: A piece may leave 1 / SLACK of its own length unused in its class's share.
SLACK = 32
#: Sequence ids: partition number times this, plus a count in the partition.
PARTITION_STRIDE = 1 << 40

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, class int")
_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                  ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                  ("sequence_id", pa.int64()), ("offset", pa.int64()), ("class", pa.int32())])


def cuts(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of ``n`` ids, in order."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity // k - rest <= rest // slack:
            out.append((rest, k))
            break
        share = capacity // (k + 1)
        out.append((share, capacity // share))
        rest -= share
    return out


class Packer:
    """Fills the bins of one partition; ``rows`` takes the finished pieces."""

    def __init__(self, partition: int, capacity: int = CAPACITY, slack: int = SLACK):
        self.capacity, self.slack = capacity, slack
        self.next_id = partition * PARTITION_STRIDE
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        for length, k in cuts(total, self.capacity, self.slack):
            piece = (doc_id, start, ids[start:start + length], total)
            start += length
            if k == 1:
                self.close([piece], 1)
                continue
            held = self.open.setdefault(k, [])
            held.append(piece)
            if len(held) == k:
                self.close(self.open.pop(k), k)

    def close(self, pieces: list[tuple], k: int) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), total,
                              self.next_id, offset, k))
            offset += len(ids)
        self.next_id += 1

    def finish(self) -> None:
        """Lay the pieces of the open bins end to end: full sequences, then powers of two."""
        pieces = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        left = sum(len(p[2]) for p in pieces)
        room, held = 0, []
        for doc_id, start, ids, total in pieces:
            while len(ids):
                if not room:
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                part, ids = ids[:room], ids[room:]
                held.append((doc_id, start, part, total))
                start, room, left = start + len(part), room - len(part), left - len(part)
                if not room:
                    self.close(held, 0)
                    held = []


def take(packer: Packer) -> pa.RecordBatch:
    rows, packer.rows = packer.rows, []
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _OUT]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT)


class Tokens:
    """Ids of texts under a byte-level BPE file of the ``tokenizers`` library.

    Texts of the characters below U+0250 go through ``tiktoken`` when the file has a
    rank file with the same vocabulary (``ranks``): the ids are the same and take a third
    of the time. Any other text, and any text that holds an added token, goes
    through ``tokenizers`` itself.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.fast = None
        added = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.plain = re.compile("[\x09\x0a\x0d\x20-\x7e\xa1-ɏ]*")
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        if ranks:
            import base64

            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table,
                                          special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if (self.fast and self.plain.fullmatch(text)
                and not (self.added and self.added.search(text))):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, slack: int = SLACK) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, ids (little-endian unsigned 32-bit
    integers), doc_tokens, sequence_id, offset, class (the bin's fixed count; 0 for the
    sequences that close a partition)."""
    require(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = Tokens(tokenizer, ranks, pattern), np.array([end_id], np.uint32)
        packer = Packer(TaskContext.get().partitionId(), capacity, slack)
        for part in slices(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(),
                                    part.column("text").to_pylist(), strict=True):
                packer.add(doc_id, np.concatenate([encode(text or ""), end]))
            yield take(packer)
        packer.finish()
        yield take(packer)

    return rows.mapInArrow(run, SCHEMA)
