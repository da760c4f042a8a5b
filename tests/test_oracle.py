"""Every registered query against its SQL oracle on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sitelens.registry import QUERIES
from tools.check_oracle import TABLES, canon, digest

SQL = {name: sql for name, sql in E.oracle_sql().items() if name in QUERIES}
QS = {name: fn for name, fn in E.queries().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QS) == set(SQL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "organization_id" in df.columns


@pytest.mark.parametrize("name", sorted(QS))
def test_query_matches_oracle(spark, con, name):
    s = canon(QS[name](spark, SF_SMALL).toPandas())
    o = canon(con.execute(SQL[name]).df())
    assert list(s.columns) == list(o.columns)
    assert len(s) == len(o)
    assert digest(s) == digest(o)
