"""Named query catalogue: each entry is a Spark plan over the driver tables and,
where the semantics are SQL-expressible, the same query as ANSI SQL for an
independent engine (the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    rows: str  # SURVEY §2 inventory ids covered


CATALOG: dict[str, Entry] = {}


def register(name: str, rows: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in CATALOG:
            raise ValueError(f"duplicate query {name}")
        CATALOG[name] = Entry(name, fn, sql, rows)
        return fn
    return deco
