"""The driver contract: entry() and every registered query against its oracle."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    from compare import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert "transaction_key" in df.columns


def test_every_query_has_an_oracle():
    from strata.plans import catalog
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(__import__("__spark_entry__").oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from compare import frame_hash
    sp = E.queries()[name](spark, SF).toPandas()
    dd = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert len(sp) == len(dd)
    assert sorted(sp.columns) == sorted(dd.columns)
    assert frame_hash(sp) == frame_hash(dd)
