"""Small Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, or 0.0 when the denominator is 0 (ANSI-safe)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def r6(c: Column | str, digits: int = 6) -> Column:
    """Round for cross-engine comparison and fold -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits) + F.lit(0.0)
