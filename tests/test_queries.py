"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402
from txlake.plans.oracle import ORACLES  # noqa: E402
from txlake.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["operation_id", "account_number_from"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, srows) == rows_of(rel.columns, rel.fetchall())
