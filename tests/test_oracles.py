"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from lakesmith.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages", "documents"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["PMID", "DOI"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())
