"""Queries with SQL match DuckDB; every dealt query is registered."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from panelwright.llm.queries import ORACLE, QUERIES
from panelwright.sources.tables import TABLES
from tools.oracle_check import rows_of

from ..conftest import SF_SMALL


def test_registered():
    assert set(QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sdf = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(cols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(cols, res.fetchall())
