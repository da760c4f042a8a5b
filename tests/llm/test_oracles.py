"""Queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest
from conftest import SF_SMALL

from sitelens.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(ORACLE[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(got) == len(want)
    got = got[columns].sort_values(columns).reset_index(drop=True)
    want = want[columns].sort_values(columns).reset_index(drop=True)
    for c in columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
