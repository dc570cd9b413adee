"""Sample tables written out as landed documents.

Three deliveries of every alert are landed: as it looked first (open, with
another impact), as it looks in ``roles``, and once more alone by its id, now
closed.  Line items become the mitigations listed by the alerts, with their
details and rates.  Spark writes it all from the given tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.operators.latest import latest_per_key
from floodmark.samples import roles
from floodmark.session import SHUFFLES_LET_GO, input_bytes, partitions_for, settings, shared_folder
from floodmark.sources.landing import BATCH_DATE, Landing

FIRST_BATCH = datetime(2001, 12, 30)
SECOND_BATCH = datetime(2001, 12, 31)
REPLY_BATCH = datetime(2002, 1, 1)
# Mitigations listed by one delivery of an alert.  Further ones follow in the
# next deliveries, a second apart, so that no document grows without bound.
LIST_SIZE = 50
# Files of a task are written side by side, since sorting by folder would hold all its rows,
# and tasks are small enough to sort what they read in memory.
TASK_SETTINGS = {
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# A reducer sorts what belongs to so many bytes of sample tables or of landed files.
TABLE_SHARE = 4 * 2**20
LANDED_SHARE = 16 * 2**20

# Kinds of documents that are made from line items.
LINE_KINDS = {
    "alerts", "alerts_by_id", "mitigations", "device_rates", "flowspec_rates", "blackhole_rates"
}

_landings: dict[tuple[str, str], Landing] = {}
_landed: set[tuple[str, str]] = set()
# Where the latest lines of a landing zone were written.
_lines: dict[tuple[str, str], str] = {}


def landing_of(spark: SparkSession, sf_dir: str, *kinds: str) -> Landing:
    """The landing zone made from the sample tables, each kind written at first use.

    The session's shuffles are raised to what is read of it, so that plans over these
    documents sort in memory however much was landed.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    landing = _landings.setdefault(key, Landing(spark, f"{new_folder(spark)}/landing"))
    missing = [kind for kind in dict.fromkeys(kinds) if (landing.root, kind) not in _landed]
    if len(LINE_KINDS.intersection(missing)) > 1:
        _write_lines(spark, sf_dir)
    for kind in missing:
        land(landing, kind, DOCUMENTS_OF[kind](spark, sf_dir))
        _landed.add((landing.root, kind))
    landed = sum(size for kind in kinds for _, size in landing.listing(kind).values())
    spark.conf.set(*partitions_for(spark, landed, LANDED_SHARE))
    return landing


def _write_lines(spark: SparkSession, sf_dir: str) -> None:
    """Write the latest lines down, so that kinds landed together shuffle them once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _lines:
        return
    lines = roles.latest_lines(spark, sf_dir).select(*roles.LINE_COLUMNS)
    path = f"{new_folder(spark)}/lines"
    sized = dict([partitions_for(spark, input_bytes(lines), TABLE_SHARE)])
    with settings(spark, TASK_SETTINGS | SHUFFLES_LET_GO | sized):
        lines.write.mode("overwrite").parquet(path, compression="zstd")
    _lines[key] = path


def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest lines, as they were written down if they were."""
    path = _lines.get((spark.sparkContext.applicationId, sf_dir))
    return spark.read.parquet(path) if path else roles.latest_lines(spark, sf_dir)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/floodmark/{uuid.uuid4().hex}"


# Documents in a file: gzip files are read from their beginning, each by one task.
FILE_DOCUMENTS = 200_000


def land(landing: Landing, kind: str, documents: DataFrame) -> None:
    """Write documents as one JSON text per line, in gzip files by batch date.

    Texts repeat the names of all fields, so they take a small part of their length.
    """
    texts = documents if documents.columns == ["batch_at", "value"] else _as_text(documents)
    dated = texts.select(F.to_date("batch_at").alias(BATCH_DATE), "value")
    writer = dated.write.mode("overwrite").partitionBy(BATCH_DATE)
    writer = writer.option("compression", "gzip").option("maxRecordsPerFile", FILE_DOCUMENTS)
    sized = dict([partitions_for(landing.spark, input_bytes(dated), TABLE_SHARE)])
    with settings(landing.spark, TASK_SETTINGS | SHUFFLES_LET_GO | sized):
        writer.text(landing.folder(kind))


def _as_text(documents: DataFrame) -> DataFrame:
    return documents.select("batch_at", F.to_json(F.struct("*")).alias("value"))


def _batch(moment: datetime) -> Column:
    return F.lit(moment.isoformat())


def _iso(moment: Column) -> Column:
    """Time as the source writes it, with a zone suffix."""
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def _ref(id_: Column) -> Column:
    return F.struct(F.struct(id_.cast("string").alias("id")).alias("data"))


def listed_mitigations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines listed by each alert with their subtypes, at most a fixed number per delivery.

    Ids follow from them (see ``_listed``), so they are not shuffled.
    """
    if (spark.sparkContext.applicationId, sf_dir) in _lines:
        lines = latest_lines(spark, sf_dir).withColumn("subtype", F.expr(roles.SUBTYPE))
    else:
        lines = latest_per_key(
            roles.table(spark, sf_dir, "lineitem").select(
                *roles.LINE_KEY, *roles.LINE_ARRIVAL, F.expr(roles.SUBTYPE).alias("subtype")
            ),
            roles.LINE_KEY,
            roles.LINE_ARRIVAL,
        )
    return (
        lines.groupBy("l_orderkey", list_part().alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "subtype"))).alias("lines"))
    )


def _listed(line: Column) -> Column:
    id_ = roles.mitigation_id(line["subtype"], F.col("l_orderkey"), line["l_linenumber"])
    return F.struct(id_.alias("id"))


def list_part() -> Column:
    return F.expr(f"(l_linenumber - 1) div {LIST_SIZE}")


def alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert role columns and the source columns, with the mitigations listed.

    One row per alert and part of its list; ``part`` is 0 for alerts without any.
    What follows from the source columns is made behind the join, which shuffles less.
    """
    source = roles.alert_source(spark, sf_dir)
    lists = listed_mitigations(spark, sf_dir)
    rows = source.join(lists, source["o_orderkey"] == lists["l_orderkey"], "left")
    return rows.select(
        "o_orderkey", "c_nationkey",
        *[F.expr(sql).alias(name) for name, sql in roles.ALERT_COLUMNS.items()],
        F.coalesce("part", F.lit(0)).alias("part"),
        F.transform("lines", _listed).alias("listed"),
    )


# Fields of an alert document below its subobject.
_SUB = (
    "countries direction fast_detected host_address impact_boundary impact_bps impact_pps"
    " ip_version misuse_types protocols severity_percent severity_threshold severity_unit"
).split()
_ATTRIBUTES = "alert_class alert_type classification importance ongoing".split()


def alert_doc(**replaced: Column) -> Column:
    """An alert document of role columns, some of them replaced.

    JSON text leaves out nulls, so optional fields are missing as they would be.
    Globally detected alerts (owners above 1000) name no managed object.
    """

    def value(name: str) -> Column:
        return replaced.get(name, F.col(name)).alias(name)

    # Not detected fast is left out for some and written out for others.
    fast = F.when(F.col("fast_detected") | (F.col("o_orderkey") % 2 == 0), F.col("fast_detected"))
    sub = [fast.alias(n) if n == "fast_detected" else value(n) for n in _SUB]
    stop = replaced.get("stop_time", F.col("stop_time"))
    owner = F.col("managed_object_id")
    is_global = owner >= 1000
    return F.struct(
        F.col("id").cast("string").alias("id"),
        F.struct(
            *[value(name) for name in _ATTRIBUTES],
            _iso(F.col("start_time")).alias("start_time"),
            F.when(stop.isNotNull(), _iso(stop)).alias("stop_time"),
            F.struct(*sub).alias("subobject"),
        ).alias("attributes"),
        F.struct(
            F.when(~is_global, _ref(owner)).alias("managed_object"),
            F.when(is_global, _ref(F.lit("1"))).alias("global_detection_settings"),
            F.when(F.col("listed").isNotNull(), F.struct(F.col("listed").alias("data"))).alias(
                "mitigation"
            ),
        ).alias("relationships"),
    )


def first_look() -> dict[str, Column]:
    """What was different when an alert was delivered first."""
    return {
        "ongoing": F.lit(True),
        "stop_time": F.lit(None).cast("timestamp_ntz"),
        "impact_bps": F.col("impact_bps") * 2,
        "impact_pps": F.lit(1.5),
    }


def closed_look() -> dict[str, Column]:
    """What an alert's own document says: closed after a day."""
    return {
        "ongoing": F.lit(False),
        "stop_time": F.col("start_time") + F.expr("interval 1 day"),
        "impact_bps": F.col("impact_bps") + 1,
    }


def part_batch(moment: datetime, part: Column) -> Column:
    """Batch time of one part of an alert's list."""
    return F.date_format(
        F.lit(moment.isoformat()).cast("timestamp_ntz") + F.make_dt_interval(secs=part),
        "yyyy-MM-dd'T'HH:mm:ss",
    )


def page_number(key: str) -> Column:
    """One page per id: nothing has to be gathered to fill a page."""
    return F.expr(f"cast({key} + 1 as int)")


def _pages(
    rows: DataFrame, key: str, last_page: Column, deliveries: list[tuple[Column, list[Column]]]
) -> DataFrame:
    """Pages with their total.  ``deliveries`` are batch times with the documents on a page."""
    pages = [
        F.struct(batch.alias("batch_at"), F.array(*docs).alias("data"))
        for batch, docs in deliveries
    ]
    return rows.select(
        page_number(key).alias("page"),
        F.struct(F.struct(last_page.alias("totalPages")).alias("pagination")).alias("meta"),
        F.inline(F.array(*pages)),
    )


def _last_page(spark: SparkSession, sf_dir: str, table: str, key: str) -> Column:
    return roles.table(spark, sf_dir, table).agg(F.max(page_number(key))).scalar()


def alert_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries of every alert; the page of the second repeats the first."""
    first, last = alert_doc(**first_look()), alert_doc()
    part = F.col("part")
    return _pages(
        alert_documents(spark, sf_dir),
        "o_orderkey",
        _last_page(spark, sf_dir, "orders", "o_orderkey"),
        [
            (part_batch(FIRST_BATCH, part), [first]),
            (part_batch(SECOND_BATCH, part), [first, last]),
        ],
    )


# Replies to questions for one alert: some are refused, some break off.
REFUSED = "importance = 9"
BROKEN = "importance = 0 and alert_type = 'dos_profiled_network'"


def alert_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reply per alert, as JSON text."""
    source = alert_documents(spark, sf_dir)
    good = F.to_json(F.struct("batch_at", F.col("doc").alias("data")))
    errors = F.struct(F.array(F.struct(F.lit("404").alias("status"))).alias("errors"))
    text = (
        F.when(F.expr(REFUSED), F.to_json(errors))
        .when(F.expr(BROKEN), F.substr(good, F.lit(1), F.length(good) - 40))
        .otherwise(good)
    )
    return source.select(
        "importance",
        "alert_type",
        part_batch(REPLY_BATCH, F.col("part")).alias("batch_at"),
        alert_doc(**closed_look()).alias("doc"),
    ).select("batch_at", text.alias("value"))


def _detail_batches() -> Column:
    """Details are landed anew with every delivery of an alert."""
    batches = [part_batch(at, list_part()) for at in (FIRST_BATCH, SECOND_BATCH, REPLY_BATCH)]
    return F.explode(F.array(*batches))


def _line_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as mitigations, with their own keys."""
    return roles.line_mitigations(latest_lines(spark, sf_dir), roles.LINE_KEY)


def mitigation_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of every mitigation."""
    stop = F.col("stop")
    doc = F.struct(
        F.col("mitigation_id").alias("id"),
        F.struct(
            "name",
            "subtype",
            F.col("user_name").alias("user"),
            _iso(F.col("start")).alias("start"),
            F.when(stop.isNotNull(), _iso(stop)).alias("stop"),
            "is_automitigation",
            "ongoing",
        ).alias("attributes"),
        F.struct(_ref(F.col("alert_id")).alias("alert")).alias("relationships"),
    )
    return _line_columns(spark, sf_dir).select(
        _detail_batches().alias("batch_at"), "mitigation_id", doc.alias("data")
    )


def _rates_batch() -> Column:
    """Rates are landed with the second delivery only."""
    return part_batch(SECOND_BATCH, list_part()).alias("batch_at")


def _alert_text() -> Column:
    return F.col("alert_id").cast("string").alias("alert_id")


def device_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of the mitigations by scrubbing devices; third lines have no packet series."""

    def stat(unit: str, series: Column) -> Column:
        return F.struct(
            F.col(f"r_drop_{unit}_avg").alias("average"),
            F.col(f"r_drop_{unit}_max").alias("max"),
            series.alias("timeseries"),
        ).alias(unit)

    bits = F.col("r_drop_bps_timeseries")
    packets = F.when(F.col("l_linenumber") != 3, F.col("r_drop_pps_timeseries"))
    attributes = F.struct(
        _iso(F.col("start")).alias("timeseries_start"),
        F.lit(roles.STEP).alias("step"),
        F.struct(F.struct(stat("bps", bits), stat("pps", packets)).alias("drop")).alias("total"),
    )
    return (
        _line_columns(spark, sf_dir)
        .where("subtype = 'tms'")
        .select(_rates_batch(), _alert_text(), "mitigation_id",
                F.struct(attributes.alias("attributes")).alias("data"))
    )


def _unit_value(unit: str) -> Column:
    return F.struct(
        F.lit(roles.STEP).alias("step"),
        _iso(F.col("start")).alias("timeseries_start"),
        F.col(f"r_drop_{unit}_avg").alias("avg_value"),
        F.col(f"r_drop_{unit}_max").alias("max_value"),
        F.col(f"r_drop_{unit}_timeseries").alias("timeseries"),
    ).alias(unit)


def _view(name: str, unit: str) -> Column:
    in_unit = F.struct(_unit_value(unit)).alias("unit")
    return F.struct(F.struct(F.struct(in_unit).alias(name)).alias("view"))


def flowspec_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both units of every flowspec, but packets missing for second lines and bits for fourth.

    Mitigations of no known method turn up as flowspecs the alert does not list.
    """
    listed_id = F.when(F.col("subtype") == "flowspec", F.col("mitigation_id")).otherwise(
        F.concat(F.lit("flowspec-foreign-"), F.col("mitigation_id"))
    )

    def reply(unit: str) -> Column:
        entry = F.struct(
            F.struct(_ref(listed_id).alias("mitigation")).alias("relationships"),
            _view("flowspec", unit).alias("attributes"),
        )
        missing = {"bps": 4, "pps": 2}[unit]
        return F.when(
            F.col("l_linenumber") != missing,
            _text(_rates_batch(), _alert_text(), F.lit(unit).alias("unit"), F.array(entry).alias("data")),
        )

    lines = _line_columns(spark, sf_dir).where(F.col("subtype").isin("flowspec", "other"))
    return _of_both_units(lines, reply)


def _text(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))


def _of_both_units(lines: DataFrame, reply: Callable[[str], Column]) -> DataFrame:
    """Replies of both units, as text since their fields differ, out of one pass; null ones are none."""
    replies = F.array(reply("bps"), reply("pps"))
    return lines.select(_rates_batch(), F.explode(replies).alias("value")).where("value is not null")


def blackhole_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per blackhole line a page of its alert's rates: one entry that counts, one that does not."""
    counted = F.when(F.col("l_linenumber") % 2 == 1, "misuse_types-7").otherwise("misuse_types-70")

    def reply(unit: str) -> Column:
        def entry(id_: Column) -> Column:
            return F.struct(id_.alias("id"), _view("blackhole", unit).alias("attributes"))

        return _text(
            _rates_batch(), F.col("l_linenumber").alias("page"), _alert_text(),
            F.lit(unit).alias("unit"),
            F.array(entry(counted), entry(F.lit("misuse_types-1"))).alias("data"),
        )

    return _of_both_units(_line_columns(spark, sf_dir).where("subtype = 'blackhole'"), reply)


def managed_object_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as managed objects, renamed between two batches."""
    customers = roles.table(spark, sf_dir, "customer")

    def doc(name: Column) -> Column:
        return F.struct(
            F.col("c_custkey").cast("string").alias("id"),
            F.struct(name.alias("name")).alias("attributes"),
        )

    former, name = doc(F.concat(F.lit("Former "), F.col("c_name"))), doc(F.col("c_name"))
    return _pages(
        customers,
        "c_custkey",
        _last_page(spark, sf_dir, "customer", "c_custkey"),
        [(_batch(FIRST_BATCH), [former]), (_batch(SECOND_BATCH), [former, name])],
    )


# Where the documents of each kind come from.
DOCUMENTS_OF = {
    "alerts": alert_pages,
    "alerts_by_id": alert_replies,
    "mitigations": mitigation_replies,
    "device_rates": device_replies,
    "flowspec_rates": flowspec_replies,
    "blackhole_rates": blackhole_replies,
    "managed_objects": managed_object_pages,
}
