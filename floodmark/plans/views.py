"""The reporting views."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark import schemas, seeds
from floodmark.functions import amounts, names, times

# The alert report adds methods up in this order: each alone, the first two
# together, all three together.
METHODS = (names.TMS, names.FLOWSPEC, names.BLACKHOLE)
GROUPS = (
    (names.TMS,),
    (names.FLOWSPEC,),
    (names.BLACKHOLE,),
    (names.TMS, names.FLOWSPEC),
    (names.TMS, names.FLOWSPEC, names.BLACKHOLE),
)
# Measures of a mitigation that are added up per alert, in pairs as reported.
MEASURES = (
    ("r_drop_bps_max", "r_drop_pps_max"),
    ("r_drop_bytes", "r_drop_packets"),
)

# Total columns in report order, with the measure and the methods they add up.
TOTALS = {
    f"{measure}_{'_and_'.join(group)}": (measure, group)
    for pair in MEASURES
    for group in GROUPS
    for measure in pair
}


@dataclass(frozen=True)
class Dimensions:
    """The four lookup tables of the report."""

    importance: DataFrame
    alert_types: DataFrame
    subtypes: DataFrame
    managed_objects: DataFrame

    @staticmethod
    def seeded(spark: SparkSession, managed_objects: DataFrame) -> Dimensions:
        """The built-in lookups with the given managed objects."""
        return Dimensions(
            seeds.seed_frame(spark, schemas.IMPORTANCE_TABLE),
            seeds.seed_frame(spark, schemas.ALERT_TYPE_TABLE),
            seeds.seed_frame(spark, schemas.SUBTYPE_TABLE),
            managed_objects,
        )


def v_alert_mitigations(mitigations: DataFrame, dims: Dimensions) -> DataFrame:
    """Mitigations of known methods, with dropped traffic in bytes and packets."""
    return mitigations.join(dims.subtypes, "subtype").select(
        "id", "mitigation_id", "alert_id", "name", "subtype", "subtype_txt",
        "is_automitigation", "user_name", "ongoing", "start", "stop",
        amounts.bits_to_bytes(F.col("r_drop_bps_sum")).alias("r_drop_bytes"),
        F.col("r_drop_pps_sum").alias("r_drop_packets"),
        "r_drop_bps_max", "r_drop_pps_max", "last_updated",
    )


def _part(measure: str, method: str) -> str:
    return f"{measure}_{method}"


def mitigation_totals(report: DataFrame) -> DataFrame:
    """What an alert's mitigations add up to: one row per alert that has any.

    Aggregating before the join keeps the join free of hot alerts.  Only the
    three single-method sums are aggregated; the joint ones follow by adding.
    Names come from the joined rows themselves, as a set that holds no more of
    them than the lookup table has, so one added later shows up like any other.
    """

    def part(measure: str, method: str) -> Column:
        # Byte counts are whole numbers and are added up as such, without overflow.
        value = F.col(measure)
        if measure == "r_drop_bytes":
            value = value.cast("decimal(19,0)")
        return F.sum(F.when(F.col("subtype") == method, value)).alias(_part(measure, method))

    parts = [part(m, method) for pair in MEASURES for m in pair for method in METHODS]
    types = F.array_sort(F.collect_set("subtype_txt"))
    return report.groupBy("alert_id").agg(
        types.alias("types"),
        F.bool_or("is_automitigation").alias("automitigation"),
        F.count(F.lit(1)).alias("n_mitigations"),
        *parts,
    )


def kept_totals(mitigations: DataFrame, dims: Dimensions, key_range: str) -> DataFrame:
    """The same for keeping, with the key ranges the mitigations were found in.

    Mitigations of unknown methods add nothing, but their ranges count: a lookup row
    may make them known.
    """
    ranges = mitigations.groupBy("alert_id").agg(F.collect_set(key_range).alias("key_ranges"))
    totals = mitigation_totals(v_alert_mitigations(mitigations, dims))
    return ranges.join(totals, "alert_id", "left")


def mitigation_types() -> Column:
    """Sorted names of the methods used on an alert, or the label for none."""
    return F.coalesce(F.col("types"), F.array(F.lit(names.NO_MITIGATION)))


def drop_totals() -> dict[str, Column]:
    """The twenty dropped-traffic totals by column name, zero where nothing was dropped."""
    totals = {}
    for name, (measure, group) in TOTALS.items():
        parts = [F.coalesce(F.col(_part(measure, m)), F.lit(0)) for m in group]
        total = reduce(add, parts)
        totals[name] = total.cast("decimal(38,0)") if measure == "r_drop_bytes" else total
    return totals


def alert_duration() -> Column:
    """Time from start to stop; open alerts count up to their last update, in whole seconds."""
    start, stop, seen = F.col("start_time"), F.col("stop_time"), F.col("last_updated")
    return F.coalesce(stop - start, times.round_to_second(seen) - times.round_to_second(start))


def v_alert(
    alerts: DataFrame, mitigations: DataFrame, dims: Dimensions, totals: DataFrame | None = None
) -> DataFrame:
    """The alert report: one row per alert of known importance and type.

    With ``totals`` of the mitigations at hand, those are not read.
    """
    importance = dims.importance.withColumnRenamed("id", "importance")
    alert_types = dims.alert_types.withColumnRenamed("id", "alert_type")
    owners = dims.managed_objects.select(
        F.col("id").alias("managed_object_id"), "managed_object_name"
    )
    if totals is None:
        totals = mitigation_totals(v_alert_mitigations(mitigations, dims))
    known = (
        alerts.join(importance, "importance")
        .join(alert_types, "alert_type")
        .join(totals, F.col("id") == F.col("alert_id"), "left")
        .join(owners, "managed_object_id", "left")
    )
    return known.select(
        "id", "alert_class", "alert_type", "alert_type_txt", "classification",
        "importance", "importance_txt", "ongoing",
        times.utc_instant(F.col("start_time")).alias("start_time"),
        times.utc_instant(F.col("stop_time")).alias("stop_time"),
        alert_duration().alias("duration"),
        "countries", "direction", "fast_detected", "host_address", "impact_boundary",
        F.coalesce("impact_bps", F.lit(0.0)).alias("impact_bps"),
        F.coalesce("impact_pps", F.lit(0.0)).alias("impact_pps"),
        "ip_version", "misuse_types", "protocols",
        "severity_percent", "severity_threshold", "severity_unit", "managed_object_id",
        F.coalesce("managed_object_name", F.lit(names.UNKNOWN_OBJECT)).alias("managed_object_name"),
        mitigation_types().alias("mitigation_types"),
        F.coalesce("automitigation", F.lit(False)).alias("automitigation"),
        F.col("alert_id").isNotNull().alias("mitigated"),
        *[total.alias(name) for name, total in drop_totals().items()],
        times.utc_instant(F.col("last_updated")).alias("last_updated"),
    )


def filter_list(report: DataFrame, column: str) -> DataFrame:
    """Distinct values of a report column.  Catalyst drops the joins not needed for it."""
    return report.select(column).distinct()


def mitigation_subtype_list(report: DataFrame) -> DataFrame:
    """Distinct mitigation types over all alerts.

    Equal lists are merged first, so that only a handful are taken apart.
    """
    lists = report.select("mitigation_types").distinct()
    return lists.select(F.explode("mitigation_types").alias("mitigation_subtypes")).distinct()


def v_operational_info(state: DataFrame) -> DataFrame:
    marks = ["alert__last_update", "managed_object__last_update"]
    return state.select("id", *[times.utc_instant(F.col(m)).alias(m) for m in marks])


# Filter lists: view name and the report column it lists.
FILTER_LISTS = {
    "v_alert_types__of_alerts": "alert_type_txt",
    "v_directions__of_alerts": "direction",
    "v_managed_object_names__of_alerts": "managed_object_name",
    "v_security_levels__of_alerts": "importance_txt",
}


def all_views(
    alerts: DataFrame,
    mitigations: DataFrame,
    dims: Dimensions,
    state: DataFrame,
    totals: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every view by name."""
    report = v_alert(alerts, mitigations, dims, totals)
    return {
        "v_alert_mitigations": v_alert_mitigations(mitigations, dims),
        "v_alert": report,
        **{view: filter_list(report, column) for view, column in FILTER_LISTS.items()},
        "v_mitigation_subtypes__of_alerts": mitigation_subtype_list(report),
        "v_operational_info": v_operational_info(state),
    }
