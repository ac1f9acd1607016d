"""Removal of repeated lines (or paragraphs) across a corpus.

Units are the lines of a text, or its paragraphs (separated by blank lines). A unit is
normalised (A-Z in lower case, runs of ASCII white space as one space, ends trimmed)
and stands for its MD5 digest. Digests are grouped over all documents; the occurrence with
the smallest (doc_id, start) stays, every other one is removed. Units that are empty after
normalisation, or have fewer than ``min_words`` words, are never removed: headings, list marks and
short answers recur without being copies.

The earliest rank of a digest is a grouped minimum with map-side combine, so a line that a
third of all documents share costs one row for each task. Only digests that occur more than
once are joined back, and a hot one is the many side of an equi-join that adaptive execution
splits. Units travel as (digest, document, start, end) without their text.

Offsets are code points of the original text. Null text has no units and stays null. Rows with
a null doc_id rank after all others; rows that share a doc_id are told apart by a hash of
their text, and equal rows are one document. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import require, slices, span_lists
from txscore.session import materialize

SPACES = re.compile("[\x09-\x0d\x20]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: What separates units, and what joins the ones that stay.
SEPARATORS = {"line": (re.compile("\n"), "\n"),
              "paragraph": (re.compile("\n(?:[\x09\x0b-\x0d\x20]*\n)+"), "\n\n")}
SPANS = "array<struct<start:long,end:long>>"


def cut(text: str, unit: str = "line") -> list[tuple[int, int]]:
    """(start, end) of the units of a text."""
    out, start = [], 0
    for m in SEPARATORS[unit][0].finditer(text):
        out.append((start, m.start()))
        start = m.end()
    return [*out, (start, len(text))]


def normalised(unit: str) -> str:
    return SPACES.sub(" ", unit.translate(LOWER)).strip(" ")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.col(id_col).isNull().alias("none"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id0"),
                       F.coalesce(F.xxhash64(text), F.lit(0)).alias("th"))


def unit_digests(keyed: DataFrame, unit: str, min_words: int = 1) -> DataFrame:
    """none, id0, th, start, end, digest of every unit of at least ``min_words`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            at, starts, ends, digests = [], [], [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                for start, end in cut(text, unit) if text else ():
                    norm = normalised(text[start:end])
                    if norm and norm.count(" ") + 1 >= min_words:
                        at.append(i)
                        starts.append(start)
                        ends.append(end)
                        digests.append(hashlib.md5(norm.encode()).digest())
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(c).take(take) for c in ("none", "id0", "th")]
                + [pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
                   pa.array(digests, pa.binary())],
                ["none", "id0", "th", "start", "end", "digest"])

    return keyed.select("none", "id0", "th", "text").mapInArrow(
        run, "none boolean, id0 long, th long, start long, end long, digest binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   unit: str = "line", min_words: int = 1) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_units (of the text, empty ones too), kept and
    removed (spans of the units that stay or go, in order) and text (what stays, joined)."""
    require(docs, id_col, text_col)
    if unit not in SEPARATORS:
        raise ValueError(f"unit must be one of {sorted(SEPARATORS)}")
    keyed = _keyed(docs, id_col, text_col)
    found = materialize(unit_digests(keyed, unit, min_words))
    rank = F.struct("none", "id0", "th", "start")
    # written out, so that both sides of the join below are plain exchanges, which adaptive
    # execution can split where a digest is hot
    first = materialize(found.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
                        .where("first <> last").select("digest", "first"))
    gone = (found.join(first, "digest").where(rank != F.col("first"))
            .groupBy("none", "id0", "th").agg(F.collect_set(F.struct("start", "end")).alias("gone")))
    rows = keyed.join(gone, ["none", "id0", "th"], "left").select("doc_id", "text", "gone")
    joint = SEPARATORS[unit][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n, kept, removed, texts = [], [], [], []
            for text, gone in zip(part.column("text").to_pylist(), part.column("gone").to_pylist(),
                                  strict=True):
                out = {(g["start"], g["end"]) for g in gone or ()}
                spans = cut(text, unit) if text is not None else []
                stay = [s for s in spans if s not in out]
                n.append(len(spans))
                kept.append(stay)
                removed.append(sorted(out))
                texts.append(None if text is None else joint.join(text[a:b] for a, b in stay))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.array(n, np.int64)), span_lists(kept),
                 span_lists(removed), pa.array(texts, pa.string())],
                ["doc_id", "n_units", "kept", "removed", "text"])

    return rows.mapInArrow(
        run, f"doc_id long, n_units long, kept {SPANS}, removed {SPANS}, text string")
