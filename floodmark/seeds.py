"""The rows every new installation starts with."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from floodmark import schemas

# Severity names.
ALERT_IMPORTANCE = [(0, "Low"), (1, "Medium"), (2, "High")]

# Detection types.
ALERT_TYPE = [
    ("dos_host_detection", "Host Detection"),
    ("dos_profiled_network", "Profiled Network"),
    ("dos_profiled_router", "Profiled Router"),
]

# Mitigation methods.
MITIGATION_SUBTYPE = [
    ("blackhole", "Blackhole"),
    ("flowspec", "FlowSpec"),
    ("tms", "TMS"),
]

# Built-in managed objects.
EPOCH = datetime(1970, 1, 1)
MANAGED_OBJECT = [
    (1, "Profiled all", EPOCH),
    (10, "Dark IP", EPOCH),
    (11, "Multicast", EPOCH),
    (27, "Internet", EPOCH),
    (28, "All Subscribers", EPOCH),
    (71, "Global Detection", EPOCH),
]

# The state row of an installation that has loaded nothing yet.
STATE_ID = 1
NEVER_LOADED = datetime(1970, 1, 1, 2)
TABLES_REVISION = 2
OPERATIONAL_INFO = [(STATE_ID, NEVER_LOADED, NEVER_LOADED, TABLES_REVISION)]

SEED_ROWS = {
    schemas.IMPORTANCE_TABLE.name: ALERT_IMPORTANCE,
    schemas.ALERT_TYPE_TABLE.name: ALERT_TYPE,
    schemas.SUBTYPE_TABLE.name: MITIGATION_SUBTYPE,
    schemas.MANAGED_OBJECT_TABLE.name: MANAGED_OBJECT,
    schemas.STATE_TABLE.name: OPERATIONAL_INFO,
}


def seed_frame(spark: SparkSession, spec: schemas.TableSpec) -> DataFrame:
    """The seed rows of one table (none for the fact tables) as a DataFrame."""
    return literal_rows(spark, SEED_ROWS.get(spec.name, []), spec.ddl)


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few constant rows written into the plan itself.

    Unlike rows shipped from Python their size is known to the planner, which
    then broadcasts them without being told to, and plans nothing to meet no rows.
    """
    schema = T.StructType.fromDDL(ddl)
    if not rows:
        return spark.sql(f"select {_fields(schema, ['null'] * len(schema.fields))} where false")
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    fields = _fields(schema, [f"col{i}" for i in range(1, len(schema.fields) + 1)])
    return spark.sql(f"select {fields} from values {values}")


def _fields(schema: T.StructType, values: list[str]) -> str:
    return ", ".join(
        f"cast({value} as {f.dataType.simpleString()}) as {f.name}"
        for f, value in zip(schema.fields, values)
    )


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, int):
        return str(value)
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
