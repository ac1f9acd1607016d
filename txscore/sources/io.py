"""Sources and sinks: CSV with explicit schema, overwrite / append sinks,
JSON-encoded metric cells, persisted fitted state and models.

Scratch and result folders live under the shared ``spark.checkpoint.dir`` of
the session (never a machine-local temporary folder)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txscore.session import ensure_checkpoint_dir

MATRIX_TYPE = "array<array<bigint>>"


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "txscore", *parts, uuid.uuid4().hex])


def read_csv(spark: SparkSession, path: str, schema: StructType | str, corrupt_col: str | None = None) -> DataFrame:
    """Header CSV with a declared schema; malformed rows kept with their text. NaN cells are
    NULL."""
    from txscore.operators.prep import nan_to_null
    r = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE") \
        .option("nanValue", "NaN")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return nan_to_null(r.csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite sink."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_run(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Create-or-append log: one batch per run, told apart by ``run_id``; a run that is written
    again replaces its batch."""
    from txscore.sources.logs import write_run
    write_run(df, path, run_id, fmt)


def params_json(params: dict) -> str:
    """Model parameters as the JSON text the metric log stores."""
    return json.dumps(params)


def decode_matrix(col: str = "confusion_matrix") -> F.Column:
    """JSON text of a 2x2 confusion matrix -> array<array<bigint>>."""
    return F.from_json(F.col(col), MATRIX_TYPE)


def save_params(df: DataFrame, path: str) -> None:
    """Persist a fitted-parameter table (small) for a later scoring job."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def long_to_wide(df: DataFrame, index: list[str], column: str, value: str, values: list[str]) -> DataFrame:
    """One column per ``column`` value (e.g. one per model), as the fold-score
    files are laid out; ``values`` fixes the column set and order."""
    return df.groupBy(*index).pivot(column, values).agg(F.first(value))


def wide_to_long(df: DataFrame, index: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """The column-per-model layout back to long rows (index…, name, value)."""
    return df.unpivot(index, columns, name, value)
