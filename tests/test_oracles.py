"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from spanforge.session import TABLES

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"scope", "precision", "recall", "f1"}
    assert df.count() >= 1


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
