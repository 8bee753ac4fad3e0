"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import hashlib
import math
import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test data missing")


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _names():
    from freshstate.plans.catalog import REGISTRY
    return sorted(REGISTRY)


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    assert set(_names()) <= set(E.queries())
    assert set(_names()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
