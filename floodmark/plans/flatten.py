"""From documents to rows of the fact tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark import schemas
from floodmark.functions import amounts, names, times
from floodmark.operators import rates as rate_ops
from floodmark.operators.latest import latest_per_key
from floodmark.sources.landing import ARRIVAL

NO_OWNER = "alert without managed object or global detection settings"

# What an alert's list of mitigations is turned into: the id the row is stored
# under, the id whose details it shows, and whose rates.
_PAIR = "pair"


def owner_id(relationships: Column, strict: bool = True) -> Column:
    """The managed object of an alert, or the global one for global detections.

    With neither, a strict load fails; otherwise the owner is null.
    """
    linked = relationships["managed_object"]["data"]["id"].cast("int")
    is_global = relationships["global_detection_settings"].isNotNull()
    neither = F.raise_error(F.lit(NO_OWNER)) if strict else F.lit(None)
    return (
        F.when(linked.isNotNull(), linked)
        .when(is_global, names.GLOBAL_DETECTION_ID)
        .otherwise(neither.cast("int"))
    )


def fast_detected(subobject: Column) -> Column:
    return F.coalesce(subobject["fast_detected"], F.lit(False))


def flatten_alerts(alerts: DataFrame, now: datetime, strict: bool = True) -> DataFrame:
    """Alert elements to table rows; the arrival columns are kept for the upsert."""
    doc = F.col("doc")
    attributes = doc["attributes"]
    sub = attributes["subobject"]
    computed = {
        "id": doc["id"].cast("int"),
        "start_time": times.parse_ntz(attributes["start_time"]),
        "stop_time": times.parse_ntz(attributes["stop_time"]),
        "fast_detected": fast_detected(sub),
        "managed_object_id": owner_id(doc["relationships"], strict),
        "last_updated": times.ntz(now),
    }
    in_sub = set(subobject_fields())

    def value(column: str) -> Column:
        if column in computed:
            return computed[column]
        return sub[column] if column in in_sub else attributes[column]

    rows = [value(c).alias(c) for c in schemas.ALERT_TABLE.columns]
    return alerts.select(*rows, *ARRIVAL)


def subobject_fields() -> list[str]:
    """Names of the fields an alert keeps in its subobject."""
    page = T.StructType.fromDDL(schemas.ALERT_REPLY)
    return page["data"].dataType["attributes"].dataType["subobject"].dataType.fieldNames()


def flatten_managed_objects(objects: DataFrame, now: datetime) -> DataFrame:
    return objects.select(
        F.col("doc.id").cast("int").alias("id"),
        F.col("doc.attributes.name").alias("managed_object_name"),
        times.ntz(now).alias("last_updated"),
        *ARRIVAL,
    )


def mitigation_pairs(alerts: DataFrame) -> DataFrame:
    """One row per alert and mitigation it lists, plus one for its blackhole rates.

    An alert delivered twice in a batch counts with its last non-empty list.
    Blackhole rates belong to the alert as a whole: an extra mitigation carries
    them, with the details of the first blackhole listed.  All of this is array
    work inside the alert's row, so nothing is shuffled after the first step.
    """
    listed = F.transform("doc.relationships.mitigation.data", lambda item: item["id"])
    with_list = (
        alerts.select(*ARRIVAL, F.col("doc.id").alias("alert_id"), listed.alias("listed"))
        .where(F.size("listed") > 0)
    )
    latest = latest_per_key(with_list, ["batch_at", "alert_id"], ["page", "pos"])

    def pair(mitigation_id: Column, details_of: Column, method: Column) -> Column:
        return F.struct(
            mitigation_id.alias("mitigation_id"),
            details_of.alias("details_of"),
            method.alias("method"),
        )

    first_blackhole = F.get(
        F.filter("listed", lambda one: names.is_method(one, names.BLACKHOLE)), F.lit(0)
    )
    rates_row = pair(
        names.blackhole_rates_id(F.col("alert_id")), first_blackhole, F.lit(names.BLACKHOLE)
    )
    listed_rows = F.transform(
        F.array_distinct("listed"), lambda one: pair(one, one, _own_rates_method(one))
    )
    pairs = F.when(
        first_blackhole.isNotNull(), F.concat(listed_rows, F.array(rates_row))
    ).otherwise(listed_rows)
    return latest.select(
        *ARRIVAL, "alert_id", F.posexplode(pairs).alias("list_pos", _PAIR)
    ).select(*ARRIVAL, "alert_id", "list_pos", f"{_PAIR}.*")


def _own_rates_method(mitigation_id: Column) -> Column:
    method = names.rates_method(mitigation_id)
    return F.when(method != names.BLACKHOLE, method)


def with_details(pairs: DataFrame, details: DataFrame) -> DataFrame:
    """Attach the detail document of each mitigation, null where none was landed.

    ``details`` holds one row per batch and mitigation (see ``latest_details``).
    """
    found = details.select("batch_at", F.col("mitigation_id").alias("details_of"),
                           F.col("data").alias("detail"))
    return pairs.join(found, ["batch_at", "details_of"], "left")


def keyed_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs under the key of the row each is stored as."""
    return pairs.withColumn("id", names.mitigation_key(F.col("alert_id"), F.col("mitigation_id")))


def needed_of_details(replies: DataFrame) -> DataFrame:
    """Details without what rows are not made of."""
    data = F.struct("data.attributes", "data.relationships").alias("data")
    return replies.select("batch_at", "mitigation_id", "page", data)


def latest_details(replies: DataFrame) -> DataFrame:
    return latest_per_key(replies, ["batch_at", "mitigation_id"], ["page"])


def with_rates(pairs: DataFrame, rates: DataFrame) -> DataFrame:
    """Attach drop rates; mitigations without rates get nulls, foreign rates fall out."""
    return pairs.join(rates, rate_ops.RATE_KEY, "left")


def flatten_mitigations(pairs: DataFrame, now: datetime) -> DataFrame:
    """Pairs with details and rates to table rows, totals included.

    Pairs without a detail document have no row: nothing is known about them.
    """
    detail = F.col("detail")
    attributes = detail["attributes"]
    columns = {
        "id": names.mitigation_key(F.col("alert_id"), F.col("mitigation_id")),
        "mitigation_id": F.col("mitigation_id"),
        "alert_id": detail["relationships"]["alert"]["data"]["id"].cast("int"),
        "user_name": attributes["user"],
        "start": times.parse_ntz(attributes["start"]),
        "stop": times.parse_ntz(attributes["stop"]),
        "last_updated": times.ntz(now),
    }
    for unit in rate_ops.UNITS:
        stat = F.col(unit)
        columns |= {
            f"r_drop_{unit}_avg": stat["average"],
            f"r_drop_{unit}_max": stat["max"],
            f"r_drop_{unit}_sum": amounts.series_total(stat["timeseries"], stat["step"]),
            f"r_drop_{unit}_timeseries": stat["timeseries"],
            f"r_drop_{unit}_timeseries_start": stat["timeseries_start"],
            f"r_drop_{unit}_step": stat["step"],
        }
    rows = [
        (columns[c] if c in columns else attributes[c]).alias(c)
        for c in schemas.MITIGATION_TABLE.columns
    ]
    return pairs.where(detail.isNotNull()).select(*rows, *ARRIVAL, "list_pos")
