"""Every registered query against its DuckDB oracle on sf0.001."""

import hashlib
import math
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry, queries
from changelake.plans.oracle import oracle_sql
from changelake.plans.queries import QUERIES

TABLES = ["customer", "orders", "lineitem", "events", "supplier"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["year", "month", "day", "op", "n"]
    assert df.count() > 0
