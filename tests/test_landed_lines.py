"""Landing of several kinds at once: line items are settled once, both units come from one pass."""

import json

import pytest
from test_landing_size import sf_dir  # noqa: F401

from floodmark import schemas
from floodmark.samples import documents
from floodmark.store import Store

KINDS = ("alerts", "mitigations", "flowspec_rates", "blackhole_rates", "device_rates")


def texts(landing, kind):
    rows = landing.spark.read.text(landing.folder(kind)).collect()
    return sorted((str(r["batch_date"]), json.dumps(json.loads(r["value"]), sort_keys=True)) for r in rows)


@pytest.fixture(autouse=True)
def forgotten():
    yield
    for kept in (documents._landings, documents._landed, documents._lines):
        kept.clear()


def test_kinds_landed_together_settle_the_lines_once(spark, sf_dir, monkeypatch):  # noqa: F811
    alone = {}
    for kind in KINDS:
        alone[kind] = texts(documents.landing_of(spark, sf_dir, kind), kind)
        for kept in (documents._landings, documents._landed, documents._lines):
            kept.clear()
    made, settle = [], documents.roles.latest_lines
    monkeypatch.setattr(documents.roles, "latest_lines", lambda *a: made.append(a) or settle(*a))
    monkeypatch.setattr(documents, "latest_per_key", None)
    landing = documents.landing_of(spark, sf_dir, *KINDS)
    assert {kind: texts(landing, kind) for kind in KINDS} == alone
    assert len(made) == 1


def test_both_units_come_from_one_pass(spark, sf_dir):  # noqa: F811
    plan = documents.flowspec_replies(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan
    found = [json.loads(r["value"]) for r in documents.flowspec_replies(spark, sf_dir).collect()]
    ids = sorted((r["unit"], r["data"][0]["relationships"]["mitigation"]["data"]["id"]) for r in found)
    assert ids == [("bps", "flowspec-4-1"), ("bps", "flowspec-foreign-other-4-51"),
                   ("pps", "flowspec-4-1"), ("pps", "flowspec-foreign-other-4-51")]


def test_nothing_is_shuffled_to_meet_an_empty_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create()
    rows = spark.range(100_000).selectExpr("timestamp_ntz '2024-05-02' + make_dt_interval(id) as batch_at")
    left = rows.join(store.loaded_batches("alerts"), "batch_at", "left_anti")
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and left.count() == 100_000
    assert store.ledger.read().schema.simpleString() == schemas.LEDGER_TABLE.schema.simpleString()
