"""Every query of the library's own registry against its DuckDB oracle on the
sf0.001 tables (row count, column names, order-insensitive values).  Queries that
``__spark_entry__`` adds from elsewhere have their tests there."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from leadforge.plans import registry

from conftest import SF_SMALL

TABLES = ["customer", "documents", "pages"]
NAMES = sorted(registry.queries())


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracles())
    assert set(registry.queries()) <= set(entry.queries()) and set(registry.oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    if os.environ.get("LEADFORGE_QUICK") and name not in ("sector_contacts", "extract_anchors", "email_clean"):
        pytest.skip("quick mode")
    df = registry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.sql(registry.oracles()[name])
    assert sorted(df.columns) == sorted(res.columns)
    want = res.fetchall()
    assert _rows(df.columns, got) == _rows(res.columns, want)
