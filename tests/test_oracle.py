"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

from __spark_entry__ import entry
from snapstar.plans.catalog import queries
from snapstar.plans.oracle import oracle_sql

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    assert set(oracle_sql()) <= set(queries())
    assert set(queries()) - set(oracle_sql()) == set()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "date_key" in df.columns
