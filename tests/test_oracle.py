"""Every registered query with a SQL twin matches DuckDB on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from skyframe.plans.q_samples import build_features_sql
from skyframe.plans.registry import with_flights
from skyframe.tables import TABLES
from tests.conftest import SF_SMALL


def _twin(duck, name):
    """The SQL twin; that of build_features lists the airlines that occur in the data (fewer than 25 here)."""
    if name != "build_features":
        return E.oracle_sql()[name]
    found = duck.execute(with_flights("SELECT DISTINCT replace(replace(lower(airline), ' ', '_'), '.', '') FROM clean_flights "
                                      "WHERE airline IS NOT NULL ORDER BY 1", clean=True)).fetchall()
    return build_features_sql([r[0] for r in found])


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(_twin(duck, name))
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, cur.fetchall())


def test_entry(spark):
    assert E.entry(spark).count() > 0
