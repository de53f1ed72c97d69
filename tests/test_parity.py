"""Every registered query against its DuckDB oracle, on the smallest tables."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E

TABLES = ["events", "customer", "nation", "part", "region", "supplier", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    # values must be identical: doubles included, no rounding
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _canon(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


NAMES = [n for n in E.queries() if n.startswith("q")]


def test_every_query_has_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = {c: i for i, c in enumerate(rel.columns)}
    want = [tuple(r[idx[c]] for c in cols) for r in rel.fetchall()]
    assert len(got) == len(want)
    assert _canon(got) == _canon(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["userKey", "videoKey", "dateKey", "locationKey", "ts"]
    assert df.count() > 0
