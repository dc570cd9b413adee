"""Drop rates of mitigations, brought from three document shapes to one.

Every reply becomes *rate entries*: one row per unit (bits or packets) with a
``stat`` struct.  ``merge_units`` then makes one row per mitigation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.functions import names, times

UNITS = ("bps", "pps")
RATE_KEY = ["batch_at", "alert_id", "mitigation_id", "method"]


def _stat(average, top, series, start, step) -> Column:
    return F.struct(
        average.alias("average"),
        top.alias("max"),
        series.alias("timeseries"),
        times.parse_ntz(start).alias("timeseries_start"),
        step.alias("step"),
    )


def device_entries(replies: DataFrame) -> DataFrame:
    """Rates summed over all scrubbing devices; start and step only with a series."""
    attributes = F.col("data.attributes")

    def unit(name: str) -> Column:
        drop = attributes["total"]["drop"][name]
        has_series = drop["timeseries"].isNotNull()
        stat = _stat(
            drop["average"],
            drop["max"],
            drop["timeseries"],
            F.when(has_series, attributes["timeseries_start"]),
            F.when(has_series, attributes["step"]),
        )
        return F.struct(F.lit(name).alias("unit"), stat.alias("stat"))

    return replies.select(
        "batch_at",
        "alert_id",
        "mitigation_id",
        F.lit(names.TMS).alias("method"),
        F.struct(F.coalesce("page", F.lit(1)).alias("page"), F.lit(0).alias("pos")).alias("seq"),
        F.inline(F.array(*[unit(name) for name in UNITS])),
    )


def _view_entries(replies: DataFrame, view: str) -> DataFrame:
    exploded = replies.select(
        "batch_at", "alert_id", "unit", "page", F.posexplode("data").alias("pos", "entry")
    )
    per_unit = F.col("entry.attributes.view")[view]["unit"]

    def stat(unit: str) -> Column:
        value = per_unit[unit]
        return _stat(
            value["avg_value"],
            value["max_value"],
            value["timeseries"],
            value["timeseries_start"],
            value["step"],
        )

    stat_of_unit = F.when(F.col("unit") == "bps", stat("bps")).otherwise(stat("pps"))
    return exploded.select(
        "batch_at",
        "alert_id",
        F.col("entry.id").alias("entry_id"),
        F.col("entry.relationships.mitigation.data.id").alias("mitigation_id"),
        F.lit(view).alias("method"),
        F.struct(F.coalesce("page", F.lit(1)).alias("page"), "pos").alias("seq"),
        "unit",
        stat_of_unit.alias("stat"),
    )


def flowspec_entries(replies: DataFrame) -> DataFrame:
    """Flowspec rates, one entry per mitigation of the alert and unit."""
    return _view_entries(replies, names.FLOWSPEC).drop("entry_id")


def blackhole_entries(replies: DataFrame) -> DataFrame:
    """Blackhole rates of an alert, booked on its made-up rates mitigation."""
    entries = _view_entries(replies, names.BLACKHOLE)
    return (
        entries.where(F.col("entry_id").contains(names.BLACKHOLE_RATES_ENTRY))
        .withColumn("mitigation_id", names.blackhole_rates_id(F.col("alert_id")))
        .drop("entry_id")
    )


def merge_units(entries: DataFrame) -> DataFrame:
    """One row per mitigation with its bit and packet rates side by side.

    This is a full outer join of the two units after taking the last entry of
    each, done as a single aggregation: one shuffle, partial per map task.
    """
    return entries.groupBy(*RATE_KEY).agg(
        *[
            F.max_by("stat", F.when(F.col("unit") == unit, F.col("seq"))).alias(unit)
            for unit in UNITS
        ]
    )


def all_entries(device: DataFrame, flowspec: DataFrame, blackhole: DataFrame) -> DataFrame:
    """The three kinds of replies as one table of entries."""
    entries = device_entries(device)
    for more in (flowspec_entries(flowspec), blackhole_entries(blackhole)):
        entries = entries.unionByName(more)
    return entries
