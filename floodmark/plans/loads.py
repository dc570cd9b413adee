"""Loads: from the landing zone into the store."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.functions import times
from floodmark.operators import rates
from floodmark.operators.keyed_table import COMPRESSION
from floodmark.plans import flatten
from floodmark.session import SHUFFLES_LET_GO, settings
from floodmark.sources.landing import (
    ARRIVAL,
    BATCH_DATE,
    Landing,
    accepted,
    in_window,
    of_class,
    page_completeness,
    page_elements,
    single_elements,
)
from floodmark.store import ALERT_MARK, MANAGED_OBJECT_MARK, Listing, Store

# History of the first load, and the longest window of a later one.
INITIAL_DAYS = 30
UPDATE_MINUTES = 1440

MITIGATION_ARRIVAL = [*ARRIVAL, "list_pos"]


@dataclass(frozen=True)
class Unseen:
    """Documents of one kind in batches that were not loaded yet.

    Only dates whose folders hold other files than at the last look are read, and of
    them the batches that are not in the ledger.  When a batch landed, or when its
    time was, plays no part.
    """

    kind: str
    documents: DataFrame
    listing: Listing

    @property
    def replies(self) -> DataFrame:
        """Those that carry data."""
        return accepted(self.documents)


def unseen(store: Store, landing: Landing, kind: str, reader: str = "") -> Unseen:
    """What a load has to look at; each ``reader`` has a ledger of its own."""
    named = kind + reader
    listing, known = landing.listing(kind), store.known_listing(named)
    # Listed before anything is read: what lands meanwhile shows at the next look.
    changed = {day: size for day, size in listing.items() if known.get(day) != size}
    documents = landing.documents(kind, dates=list(changed))
    loaded = store.loaded_batches(named)
    return Unseen(named, documents.join(loaded, "batch_at", "left_anti"), changed)


def initial_load(
    store: Store,
    landing: Landing,
    now: datetime,
    days: int = INITIAL_DAYS,
    wait: bool = True,
) -> bool:
    """Load the alerts of the last days; the mark is the time before reading.

    Batches with gaps wait (see ``load_alerts``).  The mark moves only over
    complete input; the result says whether it did.
    """
    look = unseen(store, landing, "alerts")
    alerts = in_window(page_elements(look.replies), now - timedelta(days=days))
    return _load(store, landing, alerts, [look], now, wait)


def incremental_load(
    store: Store,
    landing: Landing,
    now: datetime,
    max_minutes: int | None = None,
    and_ongoing: bool = False,
    wait: bool = True,
) -> bool:
    """Load the alerts of all batches not loaded yet that started since the mark.

    A batch older than the mark landed late: nothing of it was seen when the mark
    moved, so its alerts count whenever they started.  While a batch has gaps the mark
    stays.

    ``max_minutes`` clamps the window as a periodic job would; alerts older
    than that are then left out for good, so it is off unless asked for.
    ``and_ongoing`` re-reads open alerts in the same job, so that of several
    documents of an alert the one landed last wins.
    """
    mark = store.mark(ALERT_MARK)
    looks = [unseen(store, landing, "alerts")]
    alerts = since_mark(page_elements(looks[0].replies), mark)
    if max_minutes is not None:
        alerts = in_window(alerts, window_start(mark, now, max_minutes))
    if and_ongoing:
        looks.append(unseen(store, landing, "alerts_by_id"))
        open_ids = ongoing_ids(store.alert.read()).unionByName(
            alerts.where("doc.attributes.ongoing").select(F.col("doc.id").cast("int").alias("id"))
        )
        alerts = alerts.unionByName(with_ids(single_elements(looks[1].replies), open_ids))
    return _load(store, landing, alerts, looks, now, wait)


def since_mark(alerts: DataFrame, mark: datetime) -> DataFrame:
    """Denial-of-service alerts that started since the mark, and all of late batches."""
    late = F.col("batch_at") < times.lookback(times.ntz(mark))
    started = times.parse_ntz(F.col("doc.attributes.start_time"))
    return of_class(alerts).where(late | (started > times.lookback(times.ntz(mark))))


def window_start(mark: datetime, now: datetime, max_minutes: int | None) -> datetime:
    return mark if max_minutes is None else max(mark, now - timedelta(minutes=max_minutes))


def window_start_column(mark: Column, now: datetime, max_minutes: int) -> Column:
    """The same for marks held in a column."""
    return F.greatest(mark, times.ntz(now - timedelta(minutes=max_minutes)))


def refresh_ongoing(store: Store, landing: Landing, now: datetime) -> None:
    """Re-read every alert stored as ongoing from its own document, so that it can close.

    Replies of batches that were read before are passed over, and a reply older than
    the stored row changes nothing.
    """
    look = unseen(store, landing, "alerts_by_id")
    replies = of_ongoing(single_elements(look.replies), store.alert.read())
    _load(store, landing, replies, [look], now, wait=False, mark=None)


def ongoing_ids(alerts: DataFrame) -> DataFrame:
    return alerts.where("ongoing").select("id")


def of_ongoing(documents: DataFrame, alerts: DataFrame) -> DataFrame:
    """Documents of the alerts stored as ongoing."""
    return with_ids(documents, ongoing_ids(alerts))


def with_ids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    return documents.join(ids, F.col("doc.id").cast("int") == ids["id"], "left_semi")


def refresh_managed_objects(
    store: Store, landing: Landing, now: datetime, wait: bool = True
) -> bool:
    """Upsert the managed objects of all batches not loaded yet.

    Names are taken as they come; a batch that lacks pages is read again until it has
    them, and the mark stays meanwhile.
    """
    look = unseen(store, landing, "managed_objects")
    objects = flatten.flatten_managed_objects(page_elements(look.replies), now)
    store.managed_object.upsert(objects, ARRIVAL, only_later=True)
    pages = written(_pages(look), f"{store.root}/_staging/object_pages")
    waiting = _batches(missing_pages(pages))
    complete = _record(store, [look], [pages], waiting, now) or not wait
    if complete:
        store.advance_mark(MANAGED_OBJECT_MARK, now)
    return complete


def run_cycle(
    store: Store,
    landing: Landing,
    now: datetime,
    days: int = INITIAL_DAYS,
    max_minutes: int | None = None,
    wait: bool = True,
) -> None:
    """One round of loading; how often it runs is up to the caller's scheduler."""
    if not store.exists():
        store.create()
    if store.needs_initial_load():
        initial_load(store, landing, now, days, wait)
        refresh_managed_objects(store, landing, now, wait)
    else:
        refresh_managed_objects(store, landing, now, wait)
        incremental_load(store, landing, now, max_minutes, and_ongoing=True, wait=wait)


def collections(landing: Landing, since: datetime | None = None) -> DataFrame:
    """Elements of all landed alert pages."""
    return page_elements(landing.accepted("alerts", since))


def load_alerts(
    store: Store,
    landing: Landing,
    alerts: DataFrame,
    now: datetime,
    since: datetime | None = None,
    wait: bool = False,
) -> bool:
    """Upsert alerts and the mitigations they list; whether nothing had to wait.

    With ``wait``, batches with gaps (see ``gaps``) are left out until all of
    them has landed; without it, what is there is loaded.  The ledger is left alone.
    """
    staged = _staged(store, landing, alerts, since=since)
    waiting = set()
    if wait:
        waiting = _batches(_gaps(landing.accepted("alerts", since), staged.pairs))
    staged.upsert(store, waiting, now)
    return not waiting


@dataclass(frozen=True)
class Staged:
    """Alert documents and what a load needs beside them, written down.

    Alert documents are parsed once, as both tables are made from them.  So are the
    details, reduced to one per mitigation: one shared by very many alerts then meets a
    plain scan, which Spark broadcasts when it is small and otherwise splits by its
    skew handling.  Pairs are narrow, and know whether their detail was landed: which of
    them count is settled before they meet details and rates, whose series come last.
    """

    alerts: DataFrame
    pairs: DataFrame
    details: DataFrame
    entries: DataFrame

    def upsert(self, store: Store, waiting: set[datetime], now: datetime) -> None:
        """Upsert the alerts of batches that do not wait; alerts go first.

        A load that breaks off is simply repeated.  Rows that arrived later than the
        documents at hand stay as they are.
        """
        alerts, pairs = without_batches(self.alerts, waiting), without_batches(self.pairs, waiting)
        store.alert.upsert(flatten.flatten_alerts(alerts, now), ARRIVAL, only_later=True)
        by_mitigation = rates.merge_units(self.entries)

        def rows(chosen: DataFrame) -> DataFrame:
            found = flatten.with_rates(flatten.with_details(chosen, self.details), by_mitigation)
            return flatten.flatten_mitigations(found, now)

        store.upsert_mitigations(
            flatten.keyed_pairs(pairs.where("landed").drop("landed")),
            MITIGATION_ARRIVAL,
            only_later=True,
            widen=rows,
        )


def _staged(store, landing, alerts, since=None, dates=None) -> Staged:
    staging = f"{store.root}/_staging"
    replies = flatten.needed_of_details(landing.accepted("mitigations", since, dates))
    documents = written(alerts, f"{staging}/documents")
    details = written(flatten.latest_details(replies), f"{staging}/details")
    return Staged(
        documents,
        written(_looked_up(flatten.mitigation_pairs(documents), details), f"{staging}/pairs"),
        details,
        landed_entries(landing, since, dates),
    )


def _looked_up(pairs: DataFrame, details: DataFrame) -> DataFrame:
    """Pairs with whether their detail was landed."""
    found = details.select("batch_at", F.col("mitigation_id").alias("details_of"), F.lit(True).alias("landed"))
    looked_up = pairs.join(found, ["batch_at", "details_of"], "left")
    return looked_up.withColumn("landed", F.col("landed").isNotNull())


def _load(
    store: Store,
    landing: Landing,
    alerts: DataFrame,
    looks: list[Unseen],
    now: datetime,
    wait: bool,
    mark: str | None = ALERT_MARK,
) -> bool:
    """Load alerts out of some batches, then enter the batches in the ledger and move the mark.

    A batch with gaps waits, or is loaded as it is; either way it is not in the ledger
    until all of it has landed, so the rest is loaded then.
    """
    pages, waiting = _load_seen(store, landing, alerts, looks, now, wait)
    complete = _record(store, looks, pages, waiting, now) or not wait
    if complete and mark is not None:
        store.advance_mark(mark, now)
    return complete


def _load_seen(
    store: Store,
    landing: Landing,
    alerts: DataFrame,
    looks: list[Unseen],
    now: datetime,
    wait: bool,
) -> tuple[list[DataFrame], set[datetime]]:
    """Upsert alerts; the pages seen of each kind, and the batches with gaps."""
    staging = f"{store.root}/_staging"
    pages = [written(_pages(look), f"{staging}/pages_{n}") for n, look in enumerate(looks)]
    staged = _staged(store, landing, alerts, dates=_dates(pages))
    waiting = _batches(_gaps(reduce(DataFrame.unionByName, pages), staged.pairs))
    staged.upsert(store, waiting if wait else set(), now)
    return pages, waiting


def _batches(found: DataFrame) -> set[datetime]:
    """Times of the batches in a frame: as many as there were fetches, at most."""
    return {row[0] for row in found.select("batch_at").distinct().collect()}


def without_batches(rows: DataFrame, batches: set[datetime]) -> DataFrame:
    return rows.where(~_in_batches(batches)) if batches else rows


def _in_batches(batches: set[datetime]) -> Column:
    return F.col("batch_at").isin([times.ntz(batch) for batch in sorted(batches)])


def load_batches(
    store: Store,
    landing: Landing,
    kind: str,
    batches: Collection[datetime],
    elements: Callable[[DataFrame], DataFrame],
    now: datetime,
    reader: str = "",
    wait: bool = True,
) -> set[datetime]:
    """Load those of some batches that are whole and not in the ledger; returns those with gaps.

    Without ``wait`` batches with gaps are loaded too, and returned all the same.
    """
    if not batches:
        return set()
    dates = [None, *sorted({batch_at.date() for batch_at in batches})]
    asked = landing.spark.createDataFrame([(b,) for b in sorted(batches)], "batch_at timestamp_ntz")
    loaded = store.loaded_batches(kind + reader)
    documents = landing.documents(kind, dates=dates).join(asked, "batch_at", "left_semi")
    look = Unseen(kind + reader, documents.join(loaded, "batch_at", "left_anti"), {})
    alerts = of_class(elements(look.replies))
    pages, waiting = _load_seen(store, landing, alerts, [look], now, wait)
    store.record_batches(look.kind, without_batches(pages[0], waiting), now)
    return waiting


def _pages(look: Unseen) -> DataFrame:
    """What tells whether the batches at hand are whole: one row per reply, without its data."""
    replies = look.documents.where(F.col("data").isNotNull())
    return replies.select("batch_at", BATCH_DATE, "page", "meta")


def _dates(pages: list[DataFrame]) -> list[date | None]:
    """The dates details and rates of some batches may lie under, and no date at all."""
    days = reduce(DataFrame.unionByName, [p.select(BATCH_DATE, "batch_at") for p in pages])
    days = days.select(F.explode(F.array(BATCH_DATE, F.to_date("batch_at"))).alias("day"))
    found = {row["day"] for row in days.distinct().collect()}  # a row per day
    return [None, *sorted(found - {None})]


def _record(
    store: Store, looks: list[Unseen], pages: list[DataFrame], waiting: set[datetime], now: datetime
) -> bool:
    """Enter whole batches in the ledger; whether no batch has to wait.

    Dates that hold a waiting batch are looked at again in any case.
    """
    for look, seen in zip(looks, pages):
        if not look.listing:
            continue
        store.record_batches(look.kind, without_batches(seen, waiting), now)
        held = seen.where(_in_batches(waiting)) if waiting else None
        again = {row[0] for row in held.select(BATCH_DATE).distinct().collect()} if waiting else set()
        store.remember_listing(
            look.kind, {day: size for day, size in look.listing.items() if day not in again}
        )
    return not waiting


def gaps(pages: DataFrame, alerts: DataFrame, details: DataFrame) -> DataFrame:
    """What batches lack: batch_at, missing (page or detail) and how many.

    A batch is complete when all announced pages are there and every mitigation
    listed in the alerts at hand has its detail document.
    """
    return _gaps(pages, _looked_up(flatten.mitigation_pairs(alerts), details))


def _gaps(pages: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same, for pairs that know whether their detail was landed."""
    number = F.count(F.lit(1)).alias("number")
    missing = pairs.where("not landed").groupBy("batch_at").agg(number)
    return missing_pages(pages).unionByName(
        missing.select("batch_at", F.lit("detail").alias("missing"), "number")
    )


def missing_pages(pages: DataFrame) -> DataFrame:
    """Batches with fewer pages than announced."""
    short = page_completeness(pages).where("not complete")
    number = (F.col("pages_announced") - F.col("pages_seen")).cast("bigint").alias("number")
    return short.select("batch_at", F.lit("page").alias("missing"), number)


def written(rows: DataFrame, path: str) -> DataFrame:
    """The same rows, read back from a table.

    What was shuffled to make them is let go at once, not when the driver next collects
    its garbage.
    """
    with settings(rows.sparkSession, SHUFFLES_LET_GO):
        rows.write.mode("overwrite").parquet(path, compression=COMPRESSION)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def landed_entries(
    landing: Landing, since: datetime | None = None, dates: list[date | None] | None = None
) -> DataFrame:
    """Entries of all landed rates."""
    kinds = ("device_rates", "flowspec_rates", "blackhole_rates")
    return rates.all_entries(*[landing.accepted(kind, since, dates) for kind in kinds])


def landed_rates(landing: Landing) -> DataFrame:
    """All landed rates by mitigation, series included."""
    return rates.merge_units(landed_entries(landing))


def with_documents(alerts: DataFrame, details: DataFrame, by_mitigation: DataFrame) -> DataFrame:
    """The mitigations listed by the alerts, with their details and rates."""
    pairs = flatten.with_details(flatten.mitigation_pairs(alerts), details)
    return flatten.with_rates(pairs, by_mitigation)


def mitigation_rows(
    alerts: DataFrame, details: DataFrame, by_mitigation: DataFrame, now: datetime
) -> DataFrame:
    """Table rows of all mitigations listed by the alerts."""
    return flatten.flatten_mitigations(with_documents(alerts, details, by_mitigation), now)


def load_stats(alerts: DataFrame) -> DataFrame:
    """Alerts fetched, and how many of them list mitigations."""
    has_list = F.col("doc.relationships.mitigation").isNotNull()
    return alerts.agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if(has_list).alias("alerts_with_mitigations"),
    )
