"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from starforge.plans.registry import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    import duckdb
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    """The library's own queries; those of the optional subpackage that SQL can't express
    are compared with brute force in its tests."""
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    from oracle_check import kind, rows_of
    sp = E.queries()[name](spark, SF).toArrow()
    ora = con.execute(E.oracle_sql()[name]).to_arrow_table()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(ora)
    assert c1 == c2
    assert {f.name: kind(f.type) for f in sp.schema} == {f.name: kind(f.type) for f in ora.schema}
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "customer_key", "amount_sum", "amount_count", "amount_mean"]
    assert df.count() > 0
