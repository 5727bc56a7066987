"""Every registered query against its DuckDB oracle on the smallest scale folder."""

import math

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(_norm(x) for x in r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in df.columns]
    want = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    assert len(got) == len(want)
    assert sorted(got, key=_key) == sorted(want, key=_key)


def test_every_query_has_a_callable():
    from recengine.plans.registry import QUERIES as qs
    assert set(E.oracle_sql()) <= set(E.queries())
    # only the iterative ALS family lacks a SQL form (its checkable facts have queries of their own)
    assert set(qs) - set(E.oracle_sql()) == {"als_recommend", "als_grid_search", "als_rmse"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "course_id", "ranking"]
    assert df.count() > 0
