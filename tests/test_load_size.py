"""What a load writes and leaves on disk beside its tables."""

import os

from conftest import NOW, alert, by_id, detail, device_rates, page, put
from pyspark.sql import functions as F

from floodmark.plans import loads

LATER = "2024-05-03T00:00:00"


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def test_shuffles_of_written_rows_are_let_go(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    read = loads.written(rows, str(tmp_path / "rows"))
    assert shuffle_files(spark) <= before
    assert read.count() == 10


def test_what_counts_is_settled_on_narrow_rows(spark, store, landing):
    """The later delivery of one mitigation has no detail, that of the other has: they differ in batch."""
    put(landing, "alerts", page(alert(7, ["tms-1", "tms-2"])), name="a")
    put(landing, "alerts", page(alert(7, ["tms-1", "tms-2"]), batch=LATER), name="b")
    put(landing, "mitigations", detail("tms-1", 7), detail("tms-2", 7),
        detail("tms-2", 7, batch=LATER, name="newer"))
    put(landing, "device_rates", device_rates("tms-1", 7, bps=[1.0, None], pps=[2.0]),
        device_rates("tms-2", 7, bps=[5.0]), device_rates("tms-2", 7, bps=[3.0, 4.0], batch=LATER))
    store.create()
    loads.initial_load(store, landing, NOW, wait=False)
    rows = by_id(store.alert_mitigations.read())
    assert {k: (r["name"], r["r_drop_bps_timeseries"], r["r_drop_bps_sum"]) for k, r in rows.items()} == {
        "7_tms-1": ("name of tms-1", [1.0, None], 60.0),
        "7_tms-2": ("newer", [3.0, 4.0], 420.0),
    }
    staging = f"{store.root}/_staging"
    assert not os.path.exists(f"{staging}/entries")  # rates go from their documents into the rows
    pairs = spark.read.parquet(f"{staging}/pairs")
    assert "detail" not in pairs.columns
    assert sorted((str(r["batch_at"])[:10], r["mitigation_id"], r["landed"]) for r in pairs.collect()) == [
        ("2024-05-02", "tms-1", True), ("2024-05-02", "tms-2", True),
        ("2024-05-03", "tms-1", False), ("2024-05-03", "tms-2", True),
    ]
