from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import by_id
from floodmark import schemas, seeds, store as stores
from floodmark.plans import checks


def test_fresh_store_holds_the_seeds(store):
    assert not store.exists()
    store.create()
    assert store.exists()
    assert checks.verify_fresh(store)
    sizes = {spec.name: store.table(spec).count() for spec in schemas.TABLES}
    assert sizes == {
        "alert": 0,
        "alert_mitigations": 0,
        "mapper_alert_importance": 3,
        "mapper_alert_type": 3,
        "mapper_mitigation_subtype": 3,
        "mapper_managed_object": 6,
        "operational_info": 1,
    }
    for spec in schemas.TABLES:
        assert store.table(spec).columns == spec.columns


def test_verify_notices_missing_and_changed_seeds(spark, store):
    store.create()
    wrong = seeds.literal_rows(spark, [(10, "Renamed", seeds.EPOCH)], schemas.MANAGED_OBJECT)
    store.managed_object.upsert(wrong, ["last_updated"])
    assert not checks.verify_fresh(store)


def test_marks_move_one_at_a_time(store):
    store.create()
    assert store.needs_initial_load()
    assert store.mark(stores.ALERT_MARK) == datetime(1970, 1, 1, 2)
    store.set_mark(stores.ALERT_MARK, datetime(2024, 1, 1, 0, 0, 0, 123456))
    assert store.needs_initial_load()
    store.set_mark(stores.MANAGED_OBJECT_MARK, datetime(2024, 1, 2))
    store.set_mark(stores.ALERT_MARK, datetime(2024, 1, 3))
    assert not store.needs_initial_load()
    assert store.state().collect() == [(1, datetime(2024, 1, 3), datetime(2024, 1, 2), 2)]
    with pytest.raises(ValueError):
        store.set_mark("tables_revision", datetime(2024, 1, 1))


def test_create_again_empties_everything(spark, store):
    store.create()
    store.set_mark(stores.ALERT_MARK, datetime(2024, 1, 1))
    more = seeds.literal_rows(spark, [(500, "More", seeds.EPOCH)], schemas.MANAGED_OBJECT)
    store.managed_object.upsert(more, ["last_updated"])
    store.create()
    assert checks.verify_fresh(store)
    assert store.needs_initial_load()


def test_registered_views_answer_sql(spark, store):
    store.create()
    store.register()
    assert spark.sql("select * from v_alert").columns[:2] == ["id", "alert_class"]
    assert len(spark.sql("select * from v_alert").columns) == 50
    assert len(spark.sql("select * from v_alert_mitigations").columns) == 16
    row = spark.sql("select * from v_operational_info").first()
    assert row["id"] == 1
    names = by_id(spark.sql("select * from mapper_managed_object"))
    assert names[10]["managed_object_name"] == "Dark IP"


def test_a_reset_that_breaks_off_leaves_no_store(spark, store, monkeypatch):
    store.create()
    assert store.exists()
    monkeypatch.setattr(type(store.managed_object), "create", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.create()
    assert not store.exists()


def test_a_reset_drops_rows_also_where_single_partitions_are_replaced(spark, store):
    store.create()
    held = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows = spark.createDataFrame([(500, "x", datetime(2024, 1, 1))], schemas.MANAGED_OBJECT)
        store.managed_object.upsert(rows.withColumn("seq", F.lit(1)), ["seq"])
        store.create()
        assert store.managed_object.read().where("id = 500").isEmpty()
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", held)
