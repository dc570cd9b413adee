from datetime import datetime

import pytest

from floodmark import schemas
from floodmark.operators.constraints import ConstraintError, write_checked
from floodmark.plans import checks


@pytest.fixture
def bad(spark):
    rows = [(1, "a"), (1, "b"), (None, "c"), (2, None)]
    return spark.createDataFrame(rows, "id int, managed_object_name string")


def test_duplicate_keys(bad):
    assert [tuple(r) for r in checks.duplicate_keys(bad, "id").collect()] == [(1, 2)]


def test_null_counts(bad):
    found = checks.null_counts(bad, ["id", "managed_object_name"])
    assert {tuple(r) for r in found.collect()} == {("id", 1), ("managed_object_name", 1)}


def test_table_faults(bad):
    found = {tuple(r) for r in checks.table_faults(bad, schemas.MANAGED_OBJECT_TABLE).collect()}
    assert found == {("repeated key", 1), ("missing value", 1)}


def test_counts_against_expectation(spark, bad):
    counts = checks.table_counts({"bad": bad, "none": bad.where("false")})
    expected = spark.createDataFrame(
        [("bad", 4), ("none", 1), ("missing", 0)], "table_name string, expected_count bigint"
    )
    found = {r["table_name"]: r["ok"] for r in checks.compare_counts(counts, expected).collect()}
    assert found == {"bad": True, "none": False, "missing": False}
    with pytest.raises(ValueError):
        checks.require(checks.compare_counts(counts, expected))
    checks.require(checks.compare_counts(counts, expected.where("table_name = 'bad'")))


def test_writes_report_what_they_must_not_hold(spark, store):
    store.create()
    ddl = schemas.LEDGER_TABLE.ddl.replace(" NOT NULL", "")
    at = datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [("2024-01-01 a", "a", at, True, at), ("2024-01-01 b", None, at, None, at)], ddl
    )
    with pytest.raises(ConstraintError, match="loaded_batch: null kind in 1 rows, null loaded in 1 rows"):
        store.ledger.upsert(rows, ["loaded_at"])
    assert store.ledger.read().isEmpty()
    with pytest.raises(ConstraintError, match="mapper_mitigation_subtype: null subtype_txt in 1 rows"):
        write_checked(
            spark.createDataFrame([("x", None)], "subtype string, subtype_txt string"),
            schemas.SUBTYPE_TABLE,
            lambda r: r.write.format("noop").mode("overwrite").save(),
        )


def test_constraints_of_all_tables(store):
    store.create()
    tables = {spec.name: store.table(spec) for spec in schemas.TABLES}
    found = checks.faults_of_all(tables).collect()
    assert len(found) == 2 * len(schemas.TABLES) and all(row["faults"] in (0, None) for row in found)
