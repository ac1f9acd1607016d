"""Corpus pipeline: toxic documents go, one document of each group of near-duplicates
stays, long repeated passages are cut out, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept and
returns a DataFrame that is written as Parquet and read again as the next stage's
``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.llm import bk_simhash, harmonic, repeats, toxicity
from txscore.llm.common import table
from txscore.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return bk_simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without strings of 200 bytes that also start elsewhere. Null
    texts stay null; ``n_chars`` follows the text."""
    out = repeats.remove_repeats(docs, carry=tuple(docs.columns))
    text = F.when(F.col("carried.text").isNotNull(), F.col("text"))
    return out.select(*[
        text.alias(c) if c == "text"
        else F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias(c) if c == "n_chars"
        else F.col("carried")[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids."""
    out = harmonic.pack(docs, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", pack),
]

#: No SQL expresses the classifier, the merges of the tokenizer or the bins.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
