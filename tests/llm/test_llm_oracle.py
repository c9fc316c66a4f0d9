"""The queries that SQL can express, against DuckDB, on whole tables."""

import collections
import os

import duckdb
import pytest

from conftest import SF_SMALL
from tidemark.llm import queries as Q

SF = os.environ.get("TIDEMARK_ORACLE_SF", SF_SMALL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = Q.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = collections.Counter(tuple(r[c] for c in cols) for r in df.collect())
    res = con.execute(Q.oracle_sql()[name])
    names = [d[0] for d in res.description]
    want = collections.Counter(tuple(r[names.index(c)] for c in sorted(names)) for r in res.fetchall())
    assert cols == sorted(names)
    assert got == want


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 14))
