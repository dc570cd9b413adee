"""Queries on sample tables where one order has a third of all lines."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")

# Half of the hot order's lines repeat one line number.
LINES = """
    select case when hot then 7 else l_orderkey end as l_orderkey, l_partkey, l_suppkey,
      cast(case when hot and n % 2 = 0 then n // 3 + 1 when hot then 1 else l_linenumber end as int)
        as l_linenumber,
      l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
    from (select *, n % 3 = 0 as hot from (select *, row_number() over () as n from '{path}'))
"""


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for name in TABLES:
        path = f"{SF_DIR}/{name}.parquet"
        rows = LINES.format(path=path) if name == "lineitem" else f"select * from '{path}'"
        con.execute(f"copy ({rows}) to '{folder}/{name}.parquet' (format parquet)")
    return folder


@pytest.mark.parametrize(
    "name",
    ["v_alert", "latest_per_key", "upsert_mitigations", "synthetic_blackhole", "flatten_mitigations"],
)
def test_query_equals_sql(spark, skewed, name):
    found = differences(entry.queries()[name](spark, skewed), connect(skewed), entry.oracle_sql()[name])
    assert found is None
