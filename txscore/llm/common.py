"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a Python task turns into one output batch.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def require(df: DataFrame, *columns: str) -> None:
    """Raise a plain error if a needed column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found in {df.columns}")


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` (string or binary) of each slice holds
    about ``limit`` bytes; a single longer value makes a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n + 64
        yield batch.slice(start)


def span_lists(rows: Sequence[Sequence[tuple[int, int]]]) -> pa.ListArray:
    """Lists of (start, end) as an array of lists of structs."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.array([x for spans in rows for span in spans for x in span], np.int64).reshape(-1, 2)
    pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(ends), pairs)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
