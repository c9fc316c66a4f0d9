"""Every registered query against its DuckDB oracle (the driver's check) on
the smallest scale factor, or the folder in ``TIDEMARK_ORACLE_SF``."""

import collections
import os

import duckdb
import pytest

from conftest import SF_SMALL

SF = os.environ.get("TIDEMARK_ORACLE_SF", SF_SMALL)

import __spark_entry__ as E
from tidemark.plans.oracle import oracle_sql
from tidemark.plans.queries import queries

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(r[i] for i in order) for r in rows)


def test_every_query_has_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert _bag(df.columns, rows) == _bag(o_cols, o_rows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["stt", "edt", "source", "keyword", "keyword_count"]
    assert df.count() > 0
