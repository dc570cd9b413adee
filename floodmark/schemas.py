"""Column layouts of the tables and of the landed documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Table columns, in table order.
ALERT = """
    id int NOT NULL, alert_class string, alert_type string, classification string,
    importance smallint, ongoing boolean,
    start_time timestamp_ntz, stop_time timestamp_ntz,
    countries array<string>, direction string, fast_detected boolean,
    host_address string, impact_boundary string, impact_bps double, impact_pps double,
    ip_version smallint, misuse_types array<string>, protocols array<string>,
    severity_percent double, severity_threshold double, severity_unit string,
    managed_object_id int, last_updated timestamp_ntz
"""
ALERT_MITIGATIONS = """
    id string NOT NULL, mitigation_id string, alert_id int, name string, subtype string,
    is_automitigation boolean, user_name string, ongoing boolean,
    start timestamp_ntz, stop timestamp_ntz,
    r_drop_bps_avg double, r_drop_bps_max double, r_drop_bps_sum double,
    r_drop_bps_timeseries array<double>, r_drop_bps_timeseries_start timestamp_ntz,
    r_drop_bps_step int,
    r_drop_pps_avg double, r_drop_pps_max double, r_drop_pps_sum double,
    r_drop_pps_timeseries array<double>, r_drop_pps_timeseries_start timestamp_ntz,
    r_drop_pps_step int,
    last_updated timestamp_ntz
"""
ALERT_IMPORTANCE = "id smallint NOT NULL, importance_txt string"
ALERT_TYPE = "id string NOT NULL, alert_type_txt string"
MITIGATION_SUBTYPE = "subtype string NOT NULL, subtype_txt string NOT NULL"
MANAGED_OBJECT = "id int NOT NULL, managed_object_name string, last_updated timestamp_ntz"
OPERATIONAL_INFO = """
    id int NOT NULL, alert__last_update timestamp_ntz,
    managed_object__last_update timestamp_ntz, tables_revision smallint
"""
# Batches that were loaded, by the kind of their documents.
LOADED_BATCH = """
    id string NOT NULL, kind string NOT NULL, batch_at timestamp_ntz NOT NULL,
    loaded boolean NOT NULL, loaded_at timestamp_ntz
"""
# What the mitigations of an alert add up to, per measure and method, and the key ranges
# that hold them.
ALERT_TOTALS = """
    alert_id int NOT NULL, n_mitigations bigint, types array<string>, automitigation boolean,
    r_drop_bps_max_tms double, r_drop_bps_max_flowspec double, r_drop_bps_max_blackhole double,
    r_drop_pps_max_tms double, r_drop_pps_max_flowspec double, r_drop_pps_max_blackhole double,
    r_drop_bytes_tms decimal(29,0), r_drop_bytes_flowspec decimal(29,0),
    r_drop_bytes_blackhole decimal(29,0),
    r_drop_packets_tms double, r_drop_packets_flowspec double, r_drop_packets_blackhole double,
    key_ranges array<bigint>
"""


@dataclass(frozen=True)
class TableSpec:
    """One stored table: its name, columns, primary key and how keys map to key ranges.

    ``range_of`` is an SQL expression giving the number whose ranges partition
    the table.  It must depend on the key alone, so that a row never moves.
    """

    name: str
    ddl: str
    key: str
    range_of: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


ALERT_TABLE = TableSpec("alert", ALERT, "id", "id")
MITIGATION_TABLE = TableSpec(
    "alert_mitigations", ALERT_MITIGATIONS, "id", "cast(split_part(id, '_', 1) as bigint)"
)
MANAGED_OBJECT_TABLE = TableSpec("mapper_managed_object", MANAGED_OBJECT, "id", "id")
IMPORTANCE_TABLE = TableSpec("mapper_alert_importance", ALERT_IMPORTANCE, "id")
ALERT_TYPE_TABLE = TableSpec("mapper_alert_type", ALERT_TYPE, "id")
SUBTYPE_TABLE = TableSpec("mapper_mitigation_subtype", MITIGATION_SUBTYPE, "subtype")
STATE_TABLE = TableSpec("operational_info", OPERATIONAL_INFO, "id")

# The ledger and the kept totals stand beside the tables reports read; they are not of them.
TOTALS_TABLE = TableSpec("alert_totals", ALERT_TOTALS, "alert_id", "alert_id")
LEDGER_TABLE = TableSpec(
    "loaded_batch", LOADED_BATCH, "id", "cast(replace(substring(id, 1, 10), '-', '') as bigint)"
)

TABLES = (
    ALERT_TABLE,
    MITIGATION_TABLE,
    IMPORTANCE_TABLE,
    ALERT_TYPE_TABLE,
    SUBTYPE_TABLE,
    MANAGED_OBJECT_TABLE,
    STATE_TABLE,
)

# Document shapes.  Only the fields that are read are declared; the JSON reader
# skips the rest.  ``batch_at``, ``page``, ``alert_id``, ``mitigation_id`` and
# ``unit`` are added beside the document by whoever lands it.
_REF = "struct<data: struct<id: string>>"
ALERT_DOC = f"""struct<
    id: string,
    attributes: struct<
        alert_class: string, alert_type: string, classification: string,
        importance: smallint, ongoing: boolean, start_time: string, stop_time: string,
        subobject: struct<
            countries: array<string>, direction: string, fast_detected: boolean,
            host_address: string, impact_boundary: string,
            impact_bps: double, impact_pps: double, ip_version: smallint,
            misuse_types: array<string>, protocols: array<string>,
            severity_percent: double, severity_threshold: double, severity_unit: string>>,
    relationships: struct<
        managed_object: {_REF},
        global_detection_settings: {_REF},
        mitigation: struct<data: array<struct<id: string>>>>>"""
_STAT = "struct<average: double, max: double, timeseries: array<double>>"
_UNIT = """struct<step: int, timeseries_start: string, avg_value: double,
    max_value: double, timeseries: array<double>>"""
_META = "meta struct<pagination: struct<totalPages: int>>"


def _view_entry(view: str) -> str:
    return f"""struct<id: string, relationships: struct<mitigation: {_REF}>,
        attributes: struct<view: struct<{view}: struct<
            unit: struct<bps: {_UNIT}, pps: {_UNIT}>>>>>"""


ALERT_PAGE = f"batch_at string, page int, data array<{ALERT_DOC}>, {_META}"
ALERT_REPLY = f"batch_at string, page int, data {ALERT_DOC}, {_META}"
MITIGATION_REPLY = f"""batch_at string, page int, mitigation_id string,
    data struct<id: string,
        attributes: struct<name: string, subtype: string, user: string, start: string,
            stop: string, is_automitigation: boolean, ongoing: boolean>,
        relationships: struct<alert: {_REF}>>"""
DEVICE_RATES = f"""batch_at string, page int, alert_id string, mitigation_id string,
    data struct<attributes: struct<timeseries_start: string, step: int,
        total: struct<drop: struct<bps: {_STAT}, pps: {_STAT}>>>>"""
FLOWSPEC_RATES = f"""batch_at string, page int, alert_id string, unit string,
    data array<{_view_entry('flowspec')}>"""
BLACKHOLE_RATES = f"""batch_at string, page int, alert_id string, unit string,
    data array<{_view_entry('blackhole')}>"""
MANAGED_OBJECT_PAGE = f"""batch_at string, page int,
    data array<struct<id: string, attributes: struct<name: string>>>, {_META}"""
