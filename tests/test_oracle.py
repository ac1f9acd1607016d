"""Every catalogue query against its SQL oracle (DuckDB) on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL
from txscore.sources.tables import TABLES

import sys, os  # noqa: E401
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from oracle_check import digest  # noqa: E402

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "roc_auc" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]
