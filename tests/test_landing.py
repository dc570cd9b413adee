from pathlib import Path

import pytest
from pyspark.sql import functions as F

from floodmark.samples import documents
from floodmark.session import settings


def test_landed_texts_take_a_small_part_of_their_length(spark, landing):
    rows = spark.range(4000).select(
        documents.part_batch(documents.FIRST_BATCH, F.col("id") % 2 * 86400).alias("batch_at"),
        F.struct(F.struct(F.col("id").cast("string").alias("id")).alias("alert")).alias("data"),
    )
    documents.land(landing, "alerts_by_id", rows)
    folder = Path(landing.folder("alerts_by_id"))
    texts = spark.read.text(str(folder))
    length = texts.agg(F.sum(F.length("value") + 1)).first()[0]
    assert texts.select("value").distinct().count() == 4000
    assert sorted(p.name for p in folder.glob("batch_date=*")) == [
        "batch_date=2001-12-30", "batch_date=2001-12-31",
    ]
    assert sum(p.stat().st_size for p in folder.rglob("part-*")) < length / 4


def test_no_file_takes_more_documents_than_one_task_should_read(spark, landing, monkeypatch):
    monkeypatch.setattr(documents, "FILE_DOCUMENTS", 10)
    rows = spark.range(35).coalesce(1).select(
        documents.part_batch(documents.FIRST_BATCH, F.lit(0)).alias("batch_at"), "id"
    )
    documents.land(landing, "alerts", rows)
    assert len(list(Path(landing.folder("alerts")).rglob("part-*"))) == 4


def test_settings_are_put_back(spark):
    name, other = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.set(name, "77m")
    with pytest.raises(ZeroDivisionError), settings(spark, {name: "16m", other: "3"}):
        assert (spark.conf.get(name), spark.conf.get(other)) == ("16m", "3")
        1 / 0
    assert (spark.conf.get(name), spark.conf.get(other)) == ("77m", "0")
    spark.conf.unset(name)
