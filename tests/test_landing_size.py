"""Landing of sample documents: how wide its shuffles are, and how many reducers share them."""

from datetime import datetime

import pytest

from floodmark.samples import documents, queries
from floodmark.session import partitions_for, settings

PARTITIONS = "spark.sql.shuffle.partitions"


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Two orders: one with a repeated line, a line without number and one far behind, one without lines."""
    day = datetime(1998, 3, 1)
    tables = {
        "customer": (
            [(1, 3, "BUILDING", -5.0)],
            "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double",
        ),
        "orders": (
            [(key, 1, "O", "1-URGENT", 10.0, day) for key in (4, 6)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string,"
            " o_totalprice double, o_orderdate timestamp_ntz",
        ),
        "lineitem": (
            [
                (4, 1, day, 1, 1, 1.0, 1.0, 0.1, "R", "F"),
                (4, 1, day, 2, 1, 1.0, 1.0, 0.1, "A", "F"),
                (4, 2, day, 1, 1, 1.0, 1.0, 0.1, "N", "O"),
                (4, 51, day, 1, 1, 1.0, 1.0, 0.1, "N", "F"),
                (4, None, day, 1, 1, 1.0, 1.0, 0.1, "R", "F"),
            ],
            "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_partkey long, l_suppkey long,"
            " l_extendedprice double, l_quantity double, l_tax double, l_returnflag string, l_linestatus string",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_documents_list_the_latest_lines(spark, sf_dir):
    found = documents.alert_documents(spark, sf_dir).select("id", "part", "listed").collect()
    lists = {(r["id"], r["part"], tuple(x["id"] for x in r["listed"] or ())) for r in found}
    assert lists == {
        (4, 0, ("flowspec-4-1", "blackhole-4-2")),
        (4, 0, (None,)),
        (4, 1, ("other-4-51",)),
        (6, 0, ()),
    }


def test_only_source_columns_are_shuffled(spark, sf_dir):
    plan = documents.alert_documents(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter")
    assert "misuse_types" in above and "misuse_types" not in below
    assert "flowspec-" not in below and "concat(" not in below


def test_reducers_follow_the_landed_bytes(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(documents, "LANDED_SHARE", 100)
    with settings(spark, {PARTITIONS: "4"}):
        queries.all_queries()["classify_mitigation"](spark, sf_dir)
        size = sum(n for _, n in documents.landing_of(spark, sf_dir, "alerts").listing("alerts").values())
        assert int(spark.conf.get(PARTITIONS)) == -(-size // 100) > 4


def test_reducers_are_never_fewer_than_the_sessions(spark):
    with settings(spark, {PARTITIONS: "7"}):
        assert partitions_for(spark, 60, 10) == (PARTITIONS, "7")
        assert partitions_for(spark, 81, 10) == (PARTITIONS, "9")
