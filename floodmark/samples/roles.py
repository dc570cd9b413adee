"""Sample tables standing in for the fact tables and the dimension.

Orders play alerts, line items their mitigations, nations managed objects.
The expressions cover what reports must cope with: missing values, names that
are mapped nowhere, open alerts and repeated mitigation keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.operators.latest import latest_per_key

# The time at which the stand-in tables were last loaded.
LOADED_AT = datetime(2002, 1, 1, 0, 0, 0, 600_000)
LOADED_AT_SQL = "timestamp_ntz'2002-01-01 00:00:00.6'"

ALERT_COLUMNS = {
    "id": "cast(o_orderkey as int)",
    "alert_class": "case when o_orderkey % 13 = 5 then 'bgp' else 'dos' end",
    "alert_type": "case o_orderstatus when 'O' then 'dos_host_detection'"
    " when 'F' then 'dos_profiled_router' else 'dos_profiled_network' end",
    "classification": "c_mktsegment",
    "importance": "cast(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 2"
    " when o_orderpriority = '3-MEDIUM' then 1 when o_orderpriority = '5-LOW' then 0"
    " else 9 end as smallint)",
    "ongoing": "o_orderkey % 10 = 0",
    "start_time": "o_orderdate",
    "stop_time": "case when o_orderkey % 10 <> 0 then"
    " o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 5000) end",
    "countries": "case when o_orderkey % 9 <> 0 then"
    " array(concat('C', c_nationkey), concat('R', c_nationkey % 5)) end",
    "direction": "case o_custkey % 3 when 0 then 'Incoming' when 1 then 'Outgoing'"
    " else 'Internal' end",
    "fast_detected": "o_orderkey % 6 in (1, 2)",
    "host_address": "case when o_orderkey % 11 <> 0 then"
    " concat('10.0.', o_custkey % 256, '.', o_orderkey % 256) end",
    "impact_boundary": "case when o_orderkey % 8 <> 0 then concat('boundary ', c_nationkey) end",
    "impact_bps": "case when o_orderkey % 4 <> 0 then o_totalprice end",
    "impact_pps": "case when o_orderkey % 5 <> 0 then o_totalprice / 64 end",
    "ip_version": "cast(case when o_orderkey % 7 = 0 then 6 else 4 end as smallint)",
    "misuse_types": "case when o_orderkey % 10 <> 3 then"
    " array('Total Traffic', concat('Misuse ', o_orderkey % 4)) end",
    "protocols": "case when o_orderkey % 4 <> 1 then"
    " array(case when o_orderkey % 4 = 2 then 'udp' else 'tcp' end) end",
    "severity_percent": "o_totalprice / 1024",
    "severity_threshold": "c_acctbal",
    "severity_unit": "case when o_orderkey % 2 = 0 then 'bps' else 'pps' end",
    "managed_object_id": "case when c_nationkey % 5 = 0 then 1000 + c_nationkey"
    " else c_nationkey end",
    "last_updated": LOADED_AT_SQL,
}

# A line item is identified by order and line; of repeated ones the latest counts.
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ARRIVAL = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
# What columns of mitigations are made of.
LINE_COLUMNS = [*LINE_KEY, *LINE_ARRIVAL, "l_quantity", "l_tax", "l_returnflag", "l_linestatus"]

SUBTYPE = (
    "case when l_returnflag = 'R' then 'tms' when l_returnflag = 'A' then 'flowspec'"
    " when l_linestatus = 'O' then 'blackhole' else 'other' end"
)
STEP = 60
MITIGATION_COLUMNS = {
    "id": "concat(l_orderkey, '_', l_linenumber)",
    "mitigation_id": f"concat({SUBTYPE}, '-', l_orderkey, '-', l_linenumber)",
    "alert_id": "cast(l_orderkey as int)",
    "name": "concat('Mitigation ', l_partkey)",
    "subtype": SUBTYPE,
    "is_automitigation": "case when l_linenumber <> 7 then l_linestatus = 'F' end",
    "user_name": "case when l_suppkey % 3 <> 0 then concat('user ', l_suppkey) end",
    "ongoing": "l_linestatus = 'O'",
    "start": "l_shipdate",
    "stop": "case when l_linestatus <> 'O' then"
    " l_shipdate + make_dt_interval(0, cast(l_quantity as int), 0, 0) end",
    "r_drop_bps_avg": "l_extendedprice / 2",
    "r_drop_bps_max": "l_extendedprice",
    "r_drop_bps_sum": "l_extendedprice",
    "r_drop_bps_timeseries": "array(l_extendedprice, null, l_quantity)",
    "r_drop_bps_timeseries_start": "l_shipdate",
    "r_drop_bps_step": str(STEP),
    "r_drop_pps_avg": "l_quantity / 4",
    "r_drop_pps_max": "l_quantity / 2",
    "r_drop_pps_sum": "l_quantity",
    "r_drop_pps_timeseries": "array(l_quantity, l_tax)",
    "r_drop_pps_timeseries_start": "l_shipdate",
    "r_drop_pps_step": str(STEP),
    "last_updated": LOADED_AT_SQL,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(expressions: dict[str, str]):
    return [F.expr(sql).alias(name) for name, sql in expressions.items()]


def alert_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"])


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_source(spark, sf_dir).select(*_columns(ALERT_COLUMNS))


def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ARRIVAL)


def mitigation_id(subtype: Column, order: Column, line: Column) -> Column:
    """The id of a line's mitigation, as in ``MITIGATION_COLUMNS``."""
    return F.concat(subtype, F.lit("-"), order, F.lit("-"), line)


def line_mitigations(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Line items as mitigation rows, with some of their own columns kept."""
    return lines.select(*_columns(MITIGATION_COLUMNS), *keep)


def narrow_mitigations(lines: DataFrame) -> DataFrame:
    """Line items under the key of their mitigations, as an upsert derives the rest of them."""
    key = F.expr(MITIGATION_COLUMNS["id"]).alias("id")
    return lines.select(key, F.expr(LOADED_AT_SQL).alias("last_updated"), *LINE_COLUMNS)


def derived_mitigation() -> dict[str, Column]:
    """Columns of a mitigation that follow from its line item."""
    kept = ("id", "last_updated")
    return {name: F.expr(sql) for name, sql in MITIGATION_COLUMNS.items() if name not in kept}


def mitigations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_mitigations(latest_lines(spark, sf_dir))


def managed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("managed_object_name"),
        F.expr(LOADED_AT_SQL).alias("last_updated"),
    )


def points(series: Column) -> Column:
    """A series as text: every point in hundredths, a missing one as a dash."""
    hundredths = F.transform(series, lambda x: F.round(x * 100).cast("bigint").cast("string"))
    return F.array_join(hundredths, ",", "-")


def presentable(rows: DataFrame) -> DataFrame:
    """The same rows in plain column types, for comparing across engines.

    Lists of names become text, series the text of their points, intervals
    seconds, instants UTC timestamps without zone and wide decimals longs.
    """

    def plain(name: str, kind: str):
        value = F.col(name)
        if kind == "array<double>":
            return points(value)
        if kind.startswith("array"):
            return F.array_join(value.cast("array<string>"), ",")
        if kind.startswith("interval"):
            return value.cast("interval second").cast("decimal(20,6)").cast("double")
        if kind == "timestamp":
            local = value.cast("timestamp_ntz")
            return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
        if kind.startswith("decimal"):
            return value.cast("bigint")
        return value

    return rows.select(*[plain(name, kind).alias(name) for name, kind in rows.dtypes])


def rounded(rows: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Doubles among some columns rounded, as their sums depend on the order of adding."""
    doubles = [name for name, kind in rows.dtypes if kind == "double" and name in columns]
    return rows.withColumns({name: F.round(name, digits) for name in doubles})
