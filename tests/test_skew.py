"""Hot keys: one alert, mitigation or row delivered again and again."""

import pytest
from pyspark.sql import functions as F

from floodmark import schemas, seeds
from floodmark.operators import rates
from floodmark.operators.latest import latest_per_key
from floodmark.plans import flatten, views

ROWS = 60_000


def hot(id_column):
    """A third of all rows has the same value."""
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias(id_column)


def shuffled_rows(frame):
    """Rows written to the largest shuffle of a plan after running it."""
    executed = frame._jdf.queryExecution().executedPlan()
    frame._jdf.queryExecution().toRdd().count()
    found, todo = [], [executed]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            if kind == "ShuffleQueryStageExec":
                found.append(int(str(node.getRuntimeStatistics().rowCount().get())))
            todo.append(node.plan())
            continue
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return max(found)


def test_last_wins_sends_one_row_per_key_and_task(spark):
    rows = spark.range(0, ROWS, 1, 8).select(hot("k"), F.col("id").alias("seq"))
    latest = latest_per_key(rows, ["k"], ["seq"])
    assert latest.where("k = 0").first()["seq"] == ROWS - 3
    assert latest.count() == ROWS * 2 // 3 + 1
    assert shuffled_rows(latest) <= ROWS * 2 // 3 + 8


def test_totals_are_added_up_before_the_shuffle(spark):
    mitigations = spark.range(0, ROWS, 1, 8).select(
        F.col("id").cast("string").alias("id"), hot("alert_id"), F.lit("tms").alias("subtype"),
        F.lit("TMS").alias("subtype_txt"), F.lit(True).alias("is_automitigation"),
        F.lit(1.0).alias("r_drop_bps_max"), F.lit(1.0).alias("r_drop_pps_max"),
        F.lit(2).cast("bigint").alias("r_drop_bytes"), F.lit(1.0).alias("r_drop_packets"),
    )
    dims = views.Dimensions.seeded(spark, seeds.seed_frame(spark, schemas.MANAGED_OBJECT_TABLE))
    totals = views.mitigation_totals(mitigations)
    assert totals.where("alert_id = 0").first()["r_drop_bytes_tms"] == 2 * ROWS // 3
    assert shuffled_rows(totals) <= ROWS * 2 // 3 + 8


def test_units_of_a_hot_mitigation_merge_before_the_shuffle(spark):
    entries = spark.range(0, ROWS, 1, 8).select(
        F.lit("b").alias("batch_at"), F.lit("1").alias("alert_id"),
        hot("mitigation_id").cast("string").alias("mitigation_id"), F.lit("tms").alias("method"),
        F.when(F.col("id") % 2 == 0, "bps").otherwise("pps").alias("unit"),
        F.struct(F.lit(1).alias("page"), F.col("id").alias("pos")).alias("seq"),
        F.struct(F.col("id").cast("double").alias("average")).alias("stat"),
    )
    merged = rates.merge_units(entries)
    row = merged.where("mitigation_id = '0'").first()
    assert (row["bps"]["average"], row["pps"]["average"]) == (ROWS - 6.0, ROWS - 3.0)
    assert shuffled_rows(merged) <= ROWS * 2 // 3 + 8


@pytest.fixture
def small_partitions(spark):
    """Settings under which a test-sized table counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_mitigation_shared_by_very_many_alerts_is_split(spark, small_partitions, tmp_path):
    pairs = spark.range(0, ROWS, 1, 8).select(
        F.lit("b").alias("batch_at"), F.col("id").cast("string").alias("alert_id"),
        hot("details_of").cast("string").alias("details_of"),
    )
    details = spark.range(0, ROWS, 1, 8).select(
        F.lit("b").alias("batch_at"), F.col("id").cast("string").alias("mitigation_id"),
        F.lit(1).alias("page"), F.struct(F.lit("x").alias("id")).alias("data"),
    )
    path = str(tmp_path / "details")
    flatten.latest_details(details).write.parquet(path)
    joined = flatten.with_details(pairs, spark.read.parquet(path))
    assert joined.where("detail is null").count() == 0
    joined._jdf.queryExecution().toRdd().count()
    assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
