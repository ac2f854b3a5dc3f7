"""Every registered query against its DuckDB twin on the sf0.001 tables (the driver runs
the same comparison at sf0.01)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from oracle_check import TABLES
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _names():
    from heliolake.plans.changes import CHANGE_QUERIES
    from heliolake.plans.driver import QUERIES
    from heliolake.plans.storage import STORAGE_QUERIES
    return sorted(QUERIES | STORAGE_QUERIES | CHANGE_QUERIES)


def test_every_query_has_oracle():
    import __spark_entry__ as E
    assert set(_names()) <= set(E.queries()) and set(_names()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from oracle_check import compare
    sp = E.queries()[name](spark, SF).toPandas()
    dk = duck.sql(E.oracle_sql()[name]).df()
    r = compare(sp, dk)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "AC_Voltage" in df.columns
