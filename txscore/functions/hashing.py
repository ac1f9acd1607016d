"""Portable pseudo-random draws keyed by row identity.

Every random choice in the library (split, folds, samples, SMOTE gaps,
permutations) is a function of ``md5('<id>:<seed>[:<salt>]')``: the same in any
engine, independent of partitioning and retries, and not correlated with the
row id the way a linear congruence of a time-ordered id would be.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42


def row_hash(id_col: Column | str, seed: int = DEFAULT_SEED, *salt: Column | str) -> Column:
    """Hex md5 of ``id:seed[:salt…]`` -- order rows by it for a seeded shuffle."""
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    parts = [idc.cast("string"), F.lit(str(seed))]
    parts += [(F.col(s) if isinstance(s, str) else s).cast("string") for s in salt]
    return F.md5(F.concat_ws(":", *parts))


def uniform(hex_hash: Column) -> Column:
    """u in [0, 1) from the first 32 bits of a hex hash."""
    return F.conv(F.substring(hex_hash, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_sql(id_expr: str, seed: int = DEFAULT_SEED, *salt: str) -> str:
    """The same hash in ANSI SQL (for the oracle side)."""
    parts = [f"CAST({id_expr} AS VARCHAR)", f"'{seed}'"] + [f"CAST({s} AS VARCHAR)" for s in salt]
    return f"md5(concat_ws(':', {', '.join(parts)}))"


def uniform_sql(hex_expr: str) -> str:
    return f"(CAST(('0x' || substr({hex_expr}, 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"
