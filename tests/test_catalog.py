"""Every catalogue query against its DuckDB oracle on sf0.001, and the driver contract."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from check_types import SAME  # noqa: E402

from yellowstar.plans.catalog import QUERIES  # noqa: E402
from yellowstar.plans.oracle import ORACLE  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_fact_table(spark):
    df = contract.entry(spark)
    assert df.count() == 2980
    assert df.columns[0] == "vendor_key" and df.columns[-1] == "errordata"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    from yellowstar.plans.inspect import python_nodes

    df = contract.queries()[name](spark, SF)
    assert python_nodes(df) == []  # everything stays in the JVM
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.sql(contract.oracle_sql()[name])
    d_types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: SAME.get(t) for c, t in df.dtypes} == d_types
    res = duck.execute(contract.oracle_sql()[name])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows) == digest(d_cols, d_rows)
