"""Every operator as a query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark import schemas, seeds, store as stores
from floodmark.functions import amounts, names, times
from floodmark.operators import rates
from floodmark.operators.keyed_table import KeyedTable
from floodmark.operators.latest import latest_per_key
from floodmark.plans import checks, flatten, loads, views
from floodmark.samples import documents, roles
from floodmark.session import settings
from floodmark.sources import landing as landed
from floodmark.store import Store
from floodmark.streaming.stream_load import stream_alerts

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2002, 1, 2)
WINDOW_START = datetime(1998, 1, 1)
OLD_MARK = datetime(1999, 6, 1)
INITIAL_DAYS = 2000
CLAMP_MINUTES = 600 * 24 * 60
EVENT_MARK = datetime(2024, 1, 10)
LATE = datetime(2002, 3, 1)

_queries: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under the name of its function."""
    _queries[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# Sources


def _collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.collections(documents.landing_of(spark, sf_dir, "alerts"))


def _accepted(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return documents.landing_of(spark, sf_dir, kind).accepted(kind)


# Kinds of documents a load of mitigations reads.
_MITIGATION_KINDS = ("mitigations", "device_rates", "flowspec_rates", "blackhole_rates")


def _landing(spark: SparkSession, sf_dir: str, alerts: str = "alerts") -> landed.Landing:
    """A landing zone with all that a load of alerts reads."""
    return documents.landing_of(spark, sf_dir, alerts, *_MITIGATION_KINDS)


def _doc_id() -> Column:
    return F.col("doc.id").cast("int").alias("id")


@query
def scan_alerts_window(spark, sf_dir):
    found = landed.in_window(_collections(spark, sf_dir), WINDOW_START)
    started = times.parse_ntz(F.col("doc.attributes.start_time")).alias("start_time")
    return found.select("batch_at", "page", "pos", _doc_id(), started)


@query
def scan_alert_by_id(spark, sf_dir):
    replies = landed.single_elements(_accepted(spark, sf_dir, "alerts_by_id"))
    rows = flatten.flatten_alerts(replies, NOW)
    return rows.select("batch_at", "id", "alert_type", "ongoing", "stop_time", "impact_bps")


@query
def pages_union(spark, sf_dir):
    return _collections(spark, sf_dir).select("batch_at", "page", "pos", _doc_id())


@query
def scan_mitigations(spark, sf_dir):
    details = flatten.latest_details(_accepted(spark, sf_dir, "mitigations"))
    attributes = F.col("data.attributes")
    return details.select(
        "batch_at",
        "mitigation_id",
        F.col("data.relationships.alert.data.id").cast("int").alias("alert_id"),
        attributes["name"].alias("name"),
        attributes["subtype"].alias("subtype"),
        attributes["user"].alias("user_name"),
        attributes["is_automitigation"].alias("is_automitigation"),
        attributes["ongoing"].alias("ongoing"),
        times.parse_ntz(attributes["start"]).alias("start"),
        times.parse_ntz(attributes["stop"]).alias("stop"),
    )


def _rate_columns() -> list:
    columns = []
    for unit in rates.UNITS:
        stat = F.col(unit)
        columns += [
            stat["average"].alias(f"{unit}_avg"),
            stat["max"].alias(f"{unit}_max"),
            roles.points(stat["timeseries"]).alias(f"{unit}_points"),
            amounts.series_total(stat["timeseries"], stat["step"]).alias(f"{unit}_sum"),
            stat["timeseries_start"].alias(f"{unit}_start"),
            stat["step"].alias(f"{unit}_step"),
        ]
    return columns


def _alert_id() -> Column:
    return F.col("alert_id").cast("int").alias("alert_id")


@query
def rates_tms(spark, sf_dir):
    entries = rates.device_entries(_accepted(spark, sf_dir, "device_rates"))
    return rates.merge_units(entries).select(
        "batch_at", _alert_id(), "mitigation_id", *_rate_columns()
    )


@query
def rates_flowspec(spark, sf_dir):
    entries = rates.flowspec_entries(_accepted(spark, sf_dir, "flowspec_rates"))
    pairs = flatten.mitigation_pairs(_collections(spark, sf_dir))
    found = flatten.with_rates(pairs, rates.merge_units(entries))
    return found.where(F.col("method") == names.FLOWSPEC).select(
        "batch_at", _alert_id(), "mitigation_id", *_rate_columns()
    )


@query
def rates_blackhole(spark, sf_dir):
    entries = rates.blackhole_entries(_accepted(spark, sf_dir, "blackhole_rates"))
    return rates.merge_units(entries).select(
        "batch_at", _alert_id(), "mitigation_id", *_rate_columns()
    )


@query
def merge_bps_pps(spark, sf_dir):
    entries = rates.flowspec_entries(_accepted(spark, sf_dir, "flowspec_rates"))
    return rates.merge_units(entries).select(
        _alert_id(),
        "mitigation_id",
        F.col("bps.max").alias("bps_max"),
        F.col("pps.max").alias("pps_max"),
    )


@query
def scan_managed_objects(spark, sf_dir):
    objects = landed.page_elements(_accepted(spark, sf_dir, "managed_objects"))
    return objects.select(
        "batch_at", "page", "pos", _doc_id(), F.col("doc.attributes.name").alias("name")
    )


@query
def scan_reject_errors(spark, sf_dir):
    replies = documents.landing_of(spark, sf_dir, "alerts_by_id").documents("alerts_by_id")
    return landed.reply_outcome(replies).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("replies"), F.count("data").alias("alerts")
    )


@query
def ongoing_alerts(spark, sf_dir):
    return loads.ongoing_ids(roles.alerts(spark, sf_dir))


def _derived_state(spark, sf_dir):
    """One state row whose marks are the newest times in the sample tables."""
    shipped = roles.table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate")).scalar()
    return roles.table(spark, sf_dir, "orders").agg(
        F.lit(seeds.STATE_ID).alias("id"),
        F.max("o_orderdate").alias(stores.ALERT_MARK),
        F.first(shipped).alias(stores.MANAGED_OBJECT_MARK),
    )


@query
def load_mark_read(spark, sf_dir):
    return stores.read_mark(_derived_state(spark, sf_dir), stores.ALERT_MARK)


@query
def load_mark_update(spark, sf_dir):
    return stores.move_mark(_derived_state(spark, sf_dir), stores.MANAGED_OBJECT_MARK, NOW)


@query
def seed_dimensions(spark, sf_dir):
    """Every seeded name and how many alerts or mitigations bear it."""
    alerts, mitigations = roles.alerts(spark, sf_dir), roles.mitigations(spark, sf_dir)
    uses = (
        (schemas.IMPORTANCE_TABLE, "importance_txt", alerts, "importance"),
        (schemas.ALERT_TYPE_TABLE, "alert_type_txt", alerts, "alert_type"),
        (schemas.SUBTYPE_TABLE, "subtype_txt", mitigations, "subtype"),
        (schemas.MANAGED_OBJECT_TABLE, "managed_object_name", alerts, "managed_object_id"),
    )
    result = None
    for spec, label, rows, column in uses:
        counts = rows.groupBy(F.col(column).cast("string").alias("key")).agg(
            F.count(F.lit(1)).alias("uses")
        )
        seeded = seeds.seed_frame(spark, spec).select(
            F.lit(spec.name).alias("table_name"),
            F.col(spec.key).cast("string").alias("key"),
            F.col(label).alias("label"),
        )
        used = seeded.join(counts, "key", "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
        result = used if result is None else result.unionByName(used)
    return result


# Keyed writes


def _new_table(spark, spec) -> KeyedTable:
    table = KeyedTable(spark, f"{documents.new_folder(spark)}/store", spec)
    table.create()
    return table


def _first_look(alerts: DataFrame) -> DataFrame:
    return alerts.withColumns(documents.first_look())


@query
def upsert_alerts(spark, sf_dir):
    """All alerts as first seen, then those of the main class as last seen."""
    alerts = roles.alerts(spark, sf_dir)
    table = _new_table(spark, schemas.ALERT_TABLE)
    table.upsert(_first_look(alerts), ["last_updated"])
    table.upsert(alerts.where("alert_class = 'dos'"), ["last_updated"])
    return roles.presentable(table.read())


@query
def upsert_mitigations(spark, sf_dir):
    """Line items with all their repeated keys, older half first."""
    lines = roles.table(spark, sf_dir, "lineitem")
    rows, derive = roles.narrow_mitigations(lines), roles.derived_mitigation()
    older = F.col("l_shipdate") < times.ntz(WINDOW_START)
    table = _new_table(spark, schemas.MITIGATION_TABLE)
    with settings(spark, documents.TASK_SETTINGS):
        for part in (older, ~older):
            table.upsert(rows.where(part), roles.LINE_ARRIVAL, derive=derive)
    return roles.presentable(table.read())


@query
def upsert_managed_objects(spark, sf_dir):
    """Both landed batches of managed objects over the seeds."""
    objects = landed.page_elements(_accepted(spark, sf_dir, "managed_objects"))
    table = _new_table(spark, schemas.MANAGED_OBJECT_TABLE)
    table.insert_absent(seeds.seed_frame(spark, schemas.MANAGED_OBJECT_TABLE))
    table.upsert(flatten.flatten_managed_objects(objects, NOW), landed.ARRIVAL)
    return table.read()


@query
def insert_if_absent(spark, sf_dir):
    """Customers in debt first, then all: the first to come stay as they were."""
    customers = roles.table(spark, sf_dir, "customer")
    named = customers.select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_name").alias("managed_object_name"),
        times.ntz(NOW).alias("last_updated"),
        "c_acctbal",
    )
    table = _new_table(spark, schemas.MANAGED_OBJECT_TABLE)
    in_debt = named.where("c_acctbal < 0")
    table.insert_absent(in_debt.withColumn("managed_object_name", F.lit("In debt")))
    table.insert_absent(named)
    return table.read()


@query
def derive_drop_sums(spark, sf_dir):
    rows = roles.mitigations(spark, sf_dir)
    totals = [
        amounts.series_total(F.col(f"r_drop_{u}_timeseries"), F.col(f"r_drop_{u}_step")).alias(
            f"r_drop_{u}_sum"
        )
        for u in rates.UNITS
    ]
    return rows.select("id", *totals)


@query
def init_tables(spark, sf_dir):
    """Tables filled from the samples, then created anew: rows before and after."""
    store = _loaded_store(spark, sf_dir)
    tables = {spec.name: store.table(spec) for spec in schemas.TABLES}
    before = checks.table_counts(tables).withColumnRenamed("row_count", "rows_before")
    before = loads.written(before, f"{documents.new_folder(spark)}/before")
    store.create()
    after = checks.table_counts({spec.name: store.table(spec) for spec in schemas.TABLES})
    return before.join(after.withColumnRenamed("row_count", "rows_after"), "table_name")


def _loaded_store(spark, sf_dir) -> Store:
    """A new store holding the alert and mitigation roles and customers as managed objects."""
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    store.create()
    lines = roles.narrow_mitigations(roles.latest_lines(spark, sf_dir))
    with settings(spark, documents.TASK_SETTINGS):
        store.alert.upsert(roles.alerts(spark, sf_dir), ["last_updated"])
        store.alert_mitigations.upsert(lines, ["last_updated"], derive=roles.derived_mitigation())
    objects = landed.page_elements(_accepted(spark, sf_dir, "managed_objects"))
    store.managed_object.upsert(flatten.flatten_managed_objects(objects, NOW), landed.ARRIVAL)
    return store


@query
def tables_exist(spark, sf_dir):
    """Whether tables are there before and after creating them, and the alerts loaded since."""
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    found = [("before", store.exists())]
    store.create()
    found.append(("created", store.exists()))
    store.alert.upsert(roles.alerts(spark, sf_dir), ["last_updated"])
    stages = seeds.literal_rows(
        spark, [(stage, str(there)) for stage, there in found], "stage string, there boolean"
    )
    alerts = store.alert.read().agg(F.count(F.lit(1))).scalar()
    return stages.select("stage", "there", alerts.alias("alerts_loaded"))


# Flattening and scalar expressions


@query
def flatten_alerts(spark, sf_dir):
    rows = flatten.flatten_alerts(_collections(spark, sf_dir), NOW)
    return roles.presentable(rows.drop("page", "pos"))


def _mitigation_rows(spark, sf_dir) -> DataFrame:
    landing = _landing(spark, sf_dir)
    details = flatten.latest_details(flatten.needed_of_details(landing.accepted("mitigations")))
    return loads.mitigation_rows(
        loads.collections(landing), details, loads.landed_rates(landing), NOW
    )


@query
def flatten_mitigations(spark, sf_dir):
    return roles.presentable(_mitigation_rows(spark, sf_dir).drop("page", "pos", "list_pos"))


@query
def flatten_managed_objects(spark, sf_dir):
    objects = landed.page_elements(_accepted(spark, sf_dir, "managed_objects"))
    return flatten.flatten_managed_objects(objects, NOW).drop("page", "pos")


@query
def default_fast_detected(spark, sf_dir):
    found = flatten.fast_detected(F.col("doc.attributes.subobject"))
    return _collections(spark, sf_dir).select("batch_at", _doc_id(), found.alias("fast_detected"))


@query
def managed_object_fallback(spark, sf_dir):
    owner = flatten.owner_id(F.col("doc.relationships"))
    return _collections(spark, sf_dir).select(
        "batch_at", _doc_id(), owner.alias("managed_object_id")
    )


def _pairs(spark, sf_dir) -> DataFrame:
    return flatten.mitigation_pairs(_collections(spark, sf_dir))


@query
def composite_key(spark, sf_dir):
    key = names.mitigation_key(F.col("alert_id"), F.col("mitigation_id"))
    return _pairs(spark, sf_dir).select("batch_at", key.alias("id"))


@query
def synthetic_blackhole(spark, sf_dir):
    made_up = F.col("mitigation_id") == names.blackhole_rates_id(F.col("alert_id"))
    return _pairs(spark, sf_dir).where(made_up).select(
        "batch_at", _alert_id(), "mitigation_id", "details_of", "list_pos"
    )


@query
def stamp_last_updated(spark, sf_dir):
    return roles.alerts(spark, sf_dir).select("id", times.ntz(NOW).alias("last_updated"))


@query
def classify_mitigation(spark, sf_dir):
    methods = (names.TMS, names.FLOWSPEC, names.BLACKHOLE)
    one = F.col("mitigation_id")
    flags = [names.is_method(one, method).alias(f"is_{method}") for method in methods]
    return _pairs(spark, sf_dir).select("batch_at", one, *flags, "method")


@query
def rate_window_bounds(spark, sf_dir):
    attributes = F.col("doc.attributes")
    start, stop = times.request_bounds(attributes["start_time"], attributes["stop_time"], NOW)
    return _collections(spark, sf_dir).select(
        "batch_at", _doc_id(), start.alias("window_start"), stop.alias("window_end")
    )


@query
def lookback_window(spark, sf_dir):
    """Events in a load window, with the bounds of two more windows ending at the event."""
    ts = F.col("ts")
    events = roles.table(spark, sf_dir, "events")
    return events.where(ts > times.lookback(times.ntz(EVENT_MARK))).select(
        "event_id",
        times.lookback(ts).alias("two_hours_before"),
        (ts - F.make_dt_interval(days=F.lit(loads.INITIAL_DAYS))).alias("initial_start"),
        loads.window_start_column(ts, NOW.replace(year=2024), loads.UPDATE_MINUTES).alias(
            "clamped_start"
        ),
    )


@query
def needs_initial_load(spark, sf_dir):
    """Customers as installations: marked by their events, and those in debt by the seed."""
    customers = roles.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    marks = roles.table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("ts"))
    rows = customers.join(marks, F.col("c_custkey") == F.col("user_id"), "left")
    in_debt = F.col("c_acctbal") < 0
    state = rows.select(
        "c_custkey",
        F.col("ts").alias(stores.ALERT_MARK),
        F.when(in_debt, times.ntz(seeds.NEVER_LOADED))
        .otherwise(F.col("ts"))
        .alias(stores.MANAGED_OBJECT_MARK),
    )
    return state.select("c_custkey", stores.needs_initial_load().alias("needed"))


@query
def json_extract(spark, sf_dir):
    """Optional levels of a JSON text column; a missing one gives null."""
    doc = F.from_json("props", "k int, owner struct<data: struct<id: string>>")
    return roles.table(spark, sf_dir, "events").select("event_id", doc.alias("doc")).select(
        "event_id", F.col("doc.k").alias("k"), F.col("doc.owner.data.id").alias("owner_id")
    )


# Joins on documents


@query
def alert_mitigation_pairs(spark, sf_dir):
    landing = documents.landing_of(spark, sf_dir, "alerts", "mitigations")
    named = F.struct(F.struct("data.attributes.name").alias("attributes")).alias("data")
    replies = landing.accepted("mitigations").select("batch_at", "mitigation_id", "page", named)
    details = flatten.latest_details(replies)
    pairs = flatten.mitigation_pairs(loads.collections(landing))
    return flatten.with_details(pairs, details).select(
        "batch_at",
        _alert_id(),
        "list_pos",
        "mitigation_id",
        "details_of",
        "method",
        F.col("detail.attributes.name").alias("name"),
    )


# Views and their parts


def _dimensions(spark, sf_dir) -> views.Dimensions:
    return views.Dimensions.seeded(spark, roles.managed_objects(spark, sf_dir))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert report over the sample tables."""
    return views.v_alert(
        roles.alerts(spark, sf_dir), roles.mitigations(spark, sf_dir), _dimensions(spark, sf_dir)
    )


@query
def v_alert_mitigations(spark, sf_dir):
    return views.v_alert_mitigations(roles.mitigations(spark, sf_dir), _dimensions(spark, sf_dir))


@query
def v_alert(spark, sf_dir):
    return roles.presentable(roles.rounded(report(spark, sf_dir), list(views.TOTALS)))


@query
def v_alert__kept_totals(spark, sf_dir):
    """The report of a store whose mitigations came in two loads, from the totals kept beside them."""
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    store.create()
    store.managed_object.upsert(roles.managed_objects(spark, sf_dir), ["last_updated"])
    lines = roles.table(spark, sf_dir, "lineitem")
    rows, derive = roles.narrow_mitigations(lines), roles.derived_mitigation()
    older = F.col("l_shipdate") < times.ntz(WINDOW_START)
    with settings(spark, documents.TASK_SETTINGS):
        store.alert.upsert(roles.alerts(spark, sf_dir), ["last_updated"])
        for part in (older, ~older):
            store.upsert_mitigations(rows.where(part), roles.LINE_ARRIVAL, derive=derive)
    found = store.views()["v_alert"]
    return roles.presentable(roles.rounded(found, list(views.TOTALS)))


for _view, _column in views.FILTER_LISTS.items():
    _queries[_view] = lambda spark, sf_dir, column=_column: views.filter_list(
        report(spark, sf_dir), column
    )


@query
def v_mitigation_subtypes__of_alerts(spark, sf_dir):
    return views.mitigation_subtype_list(report(spark, sf_dir))


@query
def v_operational_info(spark, sf_dir):
    """Load state of one installation per customer: newest order and event."""
    ordered = roles.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias(stores.ALERT_MARK)
    )
    seen = roles.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max("ts").alias(stores.MANAGED_OBJECT_MARK)
    )
    state = ordered.join(seen, F.col("o_custkey") == F.col("user_id"), "left")
    return roles.presentable(
        views.v_operational_info(state.withColumnRenamed("o_custkey", "id"))
    )


@query
def alert_duration(spark, sf_dir):
    seconds = times.total_seconds(views.alert_duration()).cast("double")
    return roles.alerts(spark, sf_dir).select("id", seconds.alias("duration_seconds"))


@query
def mitigation_types(spark, sf_dir):
    return roles.presentable(report(spark, sf_dir).select("id", "mitigation_types"))


@query
def automitigation(spark, sf_dir):
    return report(spark, sf_dir).select("id", "automitigation")


@query
def mitigated(spark, sf_dir):
    return report(spark, sf_dir).select("id", "mitigated")


@query
def drop_totals(spark, sf_dir):
    totals = list(views.TOTALS)
    return roles.presentable(roles.rounded(report(spark, sf_dir).select("id", *totals), totals))


@query
def series_sum(spark, sf_dir):
    series = F.col("embedding").cast("array<double>")
    total = amounts.series_total(series, F.lit(roles.STEP))
    return roles.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(total, 6).alias("series_sum")
    )


@query
def latest_per_key_(spark, sf_dir):
    return latest_per_key(
        roles.table(spark, sf_dir, "lineitem"), roles.LINE_KEY, roles.LINE_ARRIVAL
    )


_queries["latest_per_key"] = _queries.pop("latest_per_key_")


# Loads


@query
def load_stats(spark, sf_dir):
    return loads.load_stats(_collections(spark, sf_dir))


@query
def load_gaps(spark, sf_dir):
    """What the landed batches lack when the details of blackholes are withheld."""
    landing = documents.landing_of(spark, sf_dir, "alerts", "mitigations")
    details = flatten.latest_details(landing.accepted("mitigations"))
    some = details.where(~names.is_method(F.col("mitigation_id"), names.BLACKHOLE))
    return loads.gaps(landing.accepted("alerts"), loads.collections(landing), some)


@query
def table_faults(spark, sf_dir):
    """Violations of the mitigation table's constraints among all line items."""
    rows = roles.line_mitigations(roles.table(spark, sf_dir, "lineitem"))
    return checks.table_faults(rows, schemas.MITIGATION_TABLE)


def _store_with(spark, rows: DataFrame, arrival: list[str]) -> Store:
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    store.create()
    store.alert.upsert(rows, arrival)
    return store


def _initial(spark, sf_dir) -> Store:
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    store.create()
    loads.initial_load(store, _landing(spark, sf_dir), NOW, INITIAL_DAYS)
    return store


@query
def initial_load(spark, sf_dir):
    store = _initial(spark, sf_dir)
    mark = times.ntz(store.mark(stores.ALERT_MARK))
    return roles.presentable(store.alert.read().withColumn("mark", mark))


@query
def initial_load__mitigations(spark, sf_dir):
    return roles.presentable(_initial(spark, sf_dir).alert_mitigations.read())


def _incremental(spark, sf_dir) -> Store:
    store = _store_with(spark, _first_look(roles.alerts(spark, sf_dir)), ["last_updated"])
    store.set_mark(stores.ALERT_MARK, OLD_MARK)
    loads.incremental_load(store, _landing(spark, sf_dir), NOW, CLAMP_MINUTES)
    return store


@query
def incremental_load(spark, sf_dir):
    """All alerts as first seen, then a load of the clamped window since an old mark."""
    return roles.presentable(_incremental(spark, sf_dir).alert.read())


@query
def incremental_load__mitigations(spark, sf_dir):
    return roles.presentable(_incremental(spark, sf_dir).alert_mitigations.read())


def _refreshed(spark, sf_dir) -> Store:
    store = _store_with(spark, roles.alerts(spark, sf_dir), ["last_updated"])
    loads.refresh_ongoing(store, _landing(spark, sf_dir, "alerts_by_id"), NOW)
    return store


@query
def refresh_ongoing(spark, sf_dir):
    return roles.presentable(_refreshed(spark, sf_dir).alert.read())


@query
def refresh_ongoing__mitigations(spark, sf_dir):
    return roles.presentable(_refreshed(spark, sf_dir).alert_mitigations.read())


@query
def load_ledger(spark, sf_dir):
    """The ledger after all batches landed long after the mark had passed them, and a load more."""
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    store.create()
    store.set_mark(stores.ALERT_MARK, LATE.replace(month=2))
    landing = _landing(spark, sf_dir)
    for minutes in range(2):
        loads.incremental_load(store, landing, LATE.replace(minute=minutes))
    landed_documents = loads.collections(landing).groupBy("batch_at").agg(
        F.count(F.lit(1)).alias("documents")
    )
    loaded_once = store.alert.read().where(F.col("last_updated") == times.ntz(LATE))
    return store.ledger.read().drop("id").join(landed_documents, "batch_at").withColumn(
        "alerts_stored", loaded_once.agg(F.count(F.lit(1))).scalar()
    )


@query
def run_cycle(spark, sf_dir):
    """Two rounds: the history, then what alerts still open say of themselves."""
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    landing = documents.landing_of(
        spark, sf_dir, "alerts", "alerts_by_id", "managed_objects", *_MITIGATION_KINDS
    )
    for day in (NOW, NOW.replace(day=3)):
        loads.run_cycle(store, landing, day, INITIAL_DAYS)
    customers = store.managed_object.read().where("last_updated > timestamp_ntz '2000-01-01'")
    marks = {
        "alerts_at": times.ntz(store.mark(stores.ALERT_MARK)),
        "objects_at": times.ntz(store.mark(stores.MANAGED_OBJECT_MARK)),
        "customers": customers.agg(F.count(F.lit(1))).scalar(),
    }
    return roles.presentable(store.alert.read().withColumns(marks))


@query
def refresh_managed_objects(spark, sf_dir):
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    store.create()
    loads.refresh_managed_objects(
        store, documents.landing_of(spark, sf_dir, "managed_objects"), NOW
    )
    mark = times.ntz(store.mark(stores.MANAGED_OBJECT_MARK))
    return store.managed_object.read().withColumn("mark", mark)


@query
def stream_upsert(spark, sf_dir):
    """Mitigation rows after streaming all landed alert pages."""
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    store.create()
    stream = stream_alerts(
        store,
        _landing(spark, sf_dir),
        f"{documents.new_folder(spark)}/checkpoint",
        clock=lambda: NOW,
    )
    stream.awaitTermination()
    return roles.presentable(store.alert_mitigations.read())


# Checks


def _role_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        schemas.ALERT_TABLE.name: roles.alerts(spark, sf_dir),
        schemas.MITIGATION_TABLE.name: roles.mitigations(spark, sf_dir),
        schemas.MANAGED_OBJECT_TABLE.name: roles.managed_objects(spark, sf_dir),
    }


@query
def table_counts(spark, sf_dir):
    return checks.table_counts(_role_tables(spark, sf_dir))


@query
def check_row_counts(spark, sf_dir):
    """Rows of the roles against the rows they were made from; repeated lines do not add up."""
    raw = {
        schemas.ALERT_TABLE.name: roles.table(spark, sf_dir, "orders"),
        schemas.MITIGATION_TABLE.name: roles.table(spark, sf_dir, "lineitem"),
        schemas.MANAGED_OBJECT_TABLE.name: roles.table(spark, sf_dir, "nation"),
    }
    expected = checks.table_counts(raw).withColumnRenamed("row_count", "expected_count")
    return checks.compare_counts(checks.table_counts(_role_tables(spark, sf_dir)), expected)


@query
def check_unique_keys(spark, sf_dir):
    """Mitigation keys that occur more than once among all line items."""
    rows = roles.line_mitigations(roles.table(spark, sf_dir, "lineitem"))
    return checks.duplicate_keys(rows, schemas.MITIGATION_TABLE.key)


@query
def check_not_null(spark, sf_dir):
    columns = ["id", "stop_time", "impact_bps", "host_address"]
    return checks.null_counts(roles.alerts(spark, sf_dir), columns)


@query
def check_seed_values(spark, sf_dir):
    """Seeded managed objects against customers as managed objects, which overwrote some."""
    customers = roles.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("managed_object_name")
    )
    expected = seeds.seed_frame(spark, schemas.MANAGED_OBJECT_TABLE)
    return checks.wrong_values(customers, expected, "id", "managed_object_name")


@query
def check_pages(spark, sf_dir):
    """Pages of fifty orders with the years as batches: years with few orders miss some."""
    orders = roles.table(spark, sf_dir, "orders")
    page = F.expr("o_orderkey div 50 + 1")
    total = orders.agg(F.max(page)).scalar()
    pages = orders.select(
        F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("batch_at"),
        page.alias("page"),
        F.struct(F.struct(total.alias("totalPages")).alias("pagination")).alias("meta"),
    )
    return landed.page_completeness(pages)


@query
def verify_fresh(spark, sf_dir):
    """A store filled from the samples against a fresh one."""
    return checks.fresh_findings(_loaded_store(spark, sf_dir))


@query
def check_constraints(spark, sf_dir):
    """Violations of the constraints of all seven tables, with repeated lines and landed pages."""
    store = Store(spark, f"{documents.new_folder(spark)}/store")
    store.create()
    objects = landed.page_elements(_accepted(spark, sf_dir, "managed_objects"))
    tables = {spec.name: store.table(spec) for spec in schemas.TABLES}
    tables |= {
        schemas.ALERT_TABLE.name: roles.alerts(spark, sf_dir),
        schemas.MITIGATION_TABLE.name: roles.line_mitigations(roles.table(spark, sf_dir, "lineitem")),
        schemas.MANAGED_OBJECT_TABLE.name: flatten.flatten_managed_objects(objects, NOW),
    }
    return checks.faults_of_all(tables)
