"""The landing zone: one folder per kind of document, one JSON document per line.

Folders may be partitioned by ``batch_date=YYYY-MM-DD`` (the date of
``batch_at``); readers that are given a lower bound then skip older dates.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark import schemas
from floodmark.functions import times
from floodmark.sources import folders

BATCH_DATE = "batch_date"
CORRUPT = "_corrupt_record"

# Folder of each kind of document and the fields read from it.
DOCUMENTS = {
    "alerts": schemas.ALERT_PAGE,
    "alerts_by_id": schemas.ALERT_REPLY,
    "mitigations": schemas.MITIGATION_REPLY,
    "device_rates": schemas.DEVICE_RATES,
    "flowspec_rates": schemas.FLOWSPEC_RATES,
    "blackhole_rates": schemas.BLACKHOLE_RATES,
    "managed_objects": schemas.MANAGED_OBJECT_PAGE,
}

# Order in which documents arrived, as far as Spark needs to know it.
ARRIVAL = ["batch_at", "page", "pos"]
AFTER_PAGES = 2**31 - 1


@dataclass(frozen=True)
class Landing:
    spark: SparkSession
    root: str

    def folder(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    def make_folder(self, kind: str) -> None:
        """Have the folder of a kind, as a stream must find it there."""
        folders.make(self.spark, self.folder(kind))

    def schema(self, kind: str) -> T.StructType:
        """Fields of a kind, with the partition date and the text of broken lines."""
        fields = T.StructType.fromDDL(DOCUMENTS[kind])
        return fields.add(BATCH_DATE, "date").add(CORRUPT, "string")

    def documents(
        self,
        kind: str,
        since: datetime | None = None,
        dates: Collection[date | None] | None = None,
    ) -> DataFrame:
        """All replies of a kind, broken and refused ones included.

        ``since`` keeps batches landed at that time or later, ``dates`` the folders of
        some dates (None for files outside of any).  A folder that was never landed
        reads as empty.
        """
        schema = self.schema(kind)
        try:
            found = self.spark.read.schema(schema).json(self.folder(kind))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], schema)
        if since is not None:
            found = found.where(landed_since(since))
        if dates is not None:
            found = found.where(landed_on(dates))
        return with_batch_time(found)

    def accepted(
        self,
        kind: str,
        since: datetime | None = None,
        dates: Collection[date | None] | None = None,
    ) -> DataFrame:
        """Replies that carry data; refused and broken ones contribute nothing."""
        return accepted(self.documents(kind, since, dates))

    def listing(self, kind: str) -> dict[date | None, tuple[int, int]]:
        """Files and bytes of each date's folder; None stands for files outside of any."""
        found: dict[date | None, tuple[int, int]] = {}
        for one in folders.entries(self.spark, self.folder(kind)):
            day, size = None, (1, one.size)
            if one.is_folder:
                name, _, value = one.name.partition("=")
                size = folders.content(self.spark, f"{self.folder(kind)}/{one.name}")
                try:
                    day = date.fromisoformat(value) if name == BATCH_DATE else None
                except ValueError:
                    day = None
            files, length = found.get(day, (0, 0))
            found[day] = (files + size[0], length + size[1])
        return found


def landed_on(dates: Collection[date | None]) -> Column:
    """Batches in the folders of some dates; files outside of any count as None."""
    days = [F.lit(day) for day in dates if day is not None]
    undated = F.lit(None in dates) & F.col(BATCH_DATE).isNull()
    return F.col(BATCH_DATE).isin(days) | undated if days else undated


def landed_since(since: datetime) -> Column:
    """Batches from a time on; undated folders are judged by the batch time alone."""
    dated = F.col(BATCH_DATE).isNull() | (F.col(BATCH_DATE) >= F.lit(since.date()))
    return dated & (times.parse_ntz(F.col("batch_at")) >= times.ntz(since))


def with_batch_time(documents: DataFrame) -> DataFrame:
    return documents.withColumn("batch_at", times.parse_ntz(F.col("batch_at")))


def accepted(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("data").isNotNull()).drop(CORRUPT, BATCH_DATE)


def reply_outcome(documents: DataFrame) -> DataFrame:
    """Each reply with what became of it.

    ``accepted`` carries data, ``partial`` carries data but a field had the
    wrong type and reads as null, ``refused`` is an error reply and ``broken``
    is not JSON.
    """
    has_data = F.col("data").isNotNull()
    clean = F.col(CORRUPT).isNull()
    outcome = (
        F.when(has_data & clean, "accepted")
        .when(has_data, "partial")
        .when(clean, "refused")
        .otherwise("broken")
    )
    return documents.withColumn("outcome", outcome)


def page_elements(pages: DataFrame) -> DataFrame:
    """Elements of all pages as one table, with their place of arrival."""
    return pages.select("batch_at", F.coalesce("page", F.lit(1)).alias("page"),
                        F.posexplode("data").alias("pos", "doc"))


def single_elements(replies: DataFrame) -> DataFrame:
    """Replies holding one object, in the same shape as page elements.

    They count as later than all pages of their batch.
    """
    return replies.select("batch_at", F.coalesce("page", F.lit(AFTER_PAGES)).alias("page"),
                          F.lit(0).alias("pos"), F.col("data").alias("doc"))


def in_window(alerts: DataFrame, start: datetime | Column) -> DataFrame:
    """Denial-of-service alerts that started after a time, less the late-arrival margin."""
    bound = times.lookback(start if isinstance(start, Column) else times.ntz(start))
    started = times.parse_ntz(F.col("doc.attributes.start_time"))
    return of_class(alerts).where(started > bound)


def of_class(alerts: DataFrame) -> DataFrame:
    """Denial-of-service alerts only, as all loads of alert pages take them."""
    return alerts.where(F.col("doc.attributes.alert_class") == "dos")


def page_completeness(pages: DataFrame) -> DataFrame:
    """Per batch: pages announced, pages seen, and whether all are there."""
    return (
        pages.groupBy("batch_at")
        .agg(
            F.max(F.coalesce("meta.pagination.totalPages", F.lit(1))).alias("pages_announced"),
            F.count_distinct(F.coalesce("page", F.lit(1))).alias("pages_seen"),
        )
        .withColumn("complete", F.col("pages_seen") == F.col("pages_announced"))
    )
