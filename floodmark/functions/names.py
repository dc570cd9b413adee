"""Keys and labels made from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks looked for in mitigation ids, and the prefix of the id
# that carries an alert's blackhole rates.
TMS, FLOWSPEC, BLACKHOLE = "tms", "flowspec", "blackhole"
BLACKHOLE_RATES_PREFIX = "blackhole-fake4rates-"
BLACKHOLE_RATES_ENTRY = "misuse_types-7"

# Labels for missing values, spelled as reports expect them.
UNKNOWN_OBJECT = "unkown"
NO_MITIGATION = "None"

# Owner of alerts raised by the global detection settings.
GLOBAL_DETECTION_ID = 71


def mitigation_key(alert_id: Column, mitigation_id: Column) -> Column:
    return F.concat(alert_id, F.lit("_"), mitigation_id)


def blackhole_rates_id(alert_id: Column) -> Column:
    return F.concat(F.lit(BLACKHOLE_RATES_PREFIX), alert_id)


def is_method(mitigation_id: Column, method: str) -> Column:
    """Whether an id names the method anywhere; one id may name several."""
    return mitigation_id.contains(method)


def rates_method(mitigation_id: Column) -> Column:
    """The method whose rates an id takes: the last of those it names.

    Null for ids naming none.  A real blackhole has no rates of its own, they
    hang on the alert.
    """
    return (
        F.when(is_method(mitigation_id, BLACKHOLE), BLACKHOLE)
        .when(is_method(mitigation_id, FLOWSPEC), FLOWSPEC)
        .when(is_method(mitigation_id, TMS), TMS)
    )
