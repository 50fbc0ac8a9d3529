"""The statements of the operators that SQL can express, in DuckDB over the same tables."""
from collections import Counter

import duckdb
import pytest

from eventide.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(res.fetchall())
