"""Every registered query against its DuckDB statement (row multiset, doubles at 6 decimals)."""

import math
import os
from collections import Counter

import duckdb
import pytest

from conftest import SF_SMALL

from __spark_entry__ import entry
from eventide.plans.oracle import ORACLE
from eventide.plans.queries import QUERIES

TABLES = ["events"]
NAMES = sorted(ORACLE)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = df.collect()
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    a = Counter(tuple(_norm(r[cols.index(c)]) for c in order) for r in rows)
    b = Counter(tuple(_norm(r[ocols.index(c)]) for c in order) for r in res.fetchall())
    assert a == b


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "prediction" in df.columns
    assert os.path.isdir(SF_SMALL)
