"""Query catalogue. Importing this package registers every plan module."""

from txscore.plans import evaluation, explaining, learning, modeling, preparation, statistics, streams  # noqa: F401
from txscore.plans.registry import CATALOG


def queries():
    return {name: e.fn for name, e in CATALOG.items()}


def oracle_sql():
    return {name: e.sql for name, e in CATALOG.items() if e.sql is not None}
