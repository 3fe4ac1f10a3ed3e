"""Queries against DuckDB, driver-like, at the smallest scale."""

import duckdb
import pandas as pd
import pytest

from lanemesh.plan_queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(frame, columns):
    def plain(v):
        if v is None or v is pd.NA or v != v:
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted(repr(tuple(plain(v) for v in r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.sql(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)
