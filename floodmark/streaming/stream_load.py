"""Micro-batch loading of landed alerts.

What is streamed are arrivals: of each landed reply its batch only.  A page or a detail
that arrives has its whole batch looked at, and the batch is loaded once all of it is
there, from the landing zone.  Until then it is pending and the load mark stands still.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from floodmark.functions import times
from floodmark.plans import loads
from floodmark.sources.landing import (
    BATCH_DATE,
    Landing,
    of_class,
    page_elements,
    single_elements,
)
from floodmark.store import ALERT_MARK, Store

# How each kind of alert document is taken apart.
_ELEMENTS = {"alerts": page_elements, "alerts_by_id": single_elements}
# The stream has a ledger of its own, beside that of batch loads.
READER = " (stream)"
_ARRIVAL = f"batch_at string, {BATCH_DATE} date"


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def stream_alerts(
    store: Store,
    landing: Landing,
    checkpoint: str,
    kind: str = "alerts",
    clock: Callable[[], datetime] = utc_now,
    files_per_batch: int | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Upsert every denial-of-service alert landed since the last run, then stop.

    Pages, details and rates may land in any order, rates before the last page or detail
    of their batch.  Without ``wait`` a batch is loaded as it is whenever something of it
    arrives.  No row is ever dropped for being late.  An epoch that is replayed after a
    failure finds its batches in the ledger and changes nothing.
    """
    arrivals = _arrivals(landing, kind, files_per_batch)
    details = _arrivals(landing, "mitigations", files_per_batch)

    def apply(batch: DataFrame, epoch: int) -> None:
        met = {row.batch_at for row in batch.distinct().collect()}  # fetches, not replies
        load_epoch(store, landing, checkpoint, epoch, met, kind, clock(), wait)

    return (
        arrivals.unionByName(details)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _arrivals(landing: Landing, kind: str, files_per_batch: int | None) -> DataFrame:
    """batch_at of every reply of a kind as it lands; nothing else is read."""
    landing.make_folder(kind)
    reader = landing.spark.readStream.schema(_ARRIVAL)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    landed = reader.json(landing.folder(kind)).where(F.col("batch_at").isNotNull())
    return landed.select(times.parse_ntz(F.col("batch_at")).alias("batch_at"))


def load_epoch(
    store: Store,
    landing: Landing,
    checkpoint: str,
    epoch: int,
    met: set[datetime],
    kind: str,
    now: datetime,
    wait: bool = True,
) -> None:
    """Load the batches of which something arrived in an epoch, as far as they are whole."""
    done, pending = store.pending(checkpoint)
    if epoch <= done:
        return
    left = loads.load_batches(
        store, landing, kind, pending | met, _ELEMENTS[kind], now, reader=READER, wait=wait
    )
    if not left or not wait:
        store.advance_mark(ALERT_MARK, now)
    store.set_pending(checkpoint, epoch, left)
