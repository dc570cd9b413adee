"""The stored tables of one installation."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark import schemas, seeds
from floodmark.functions import times
from floodmark.operators.constraints import ConstraintError, write_checked
from floodmark.operators.keyed_table import DEFAULT_RANGE_WIDTH, RANGE, Change, KeyedTable
from floodmark.operators.revisions import RevisionLog
from floodmark.plans import views

ALERT_MARK = "alert__last_update"
MANAGED_OBJECT_MARK = "managed_object__last_update"
MARKS = (ALERT_MARK, MANAGED_OBJECT_MARK)

# Which kinds of documents a mark stands for.
KINDS_OF = {
    ALERT_MARK: ("alerts", "alerts_by_id"),
    MANAGED_OBJECT_MARK: ("managed_objects",),
}

# Files and bytes per date; None stands for files outside of any date.
Listing = dict[date | None, tuple[int, int]]


@dataclass(frozen=True)
class Store:
    """Tables under one folder.  One job at a time may write to them."""

    spark: SparkSession
    root: str
    range_width: int = DEFAULT_RANGE_WIDTH

    @property
    def alert(self) -> KeyedTable:
        return self._keyed(schemas.ALERT_TABLE)

    @property
    def alert_mitigations(self) -> KeyedTable:
        return self._keyed(schemas.MITIGATION_TABLE)

    @property
    def managed_object(self) -> KeyedTable:
        return self._keyed(schemas.MANAGED_OBJECT_TABLE)

    def _keyed(self, spec: schemas.TableSpec) -> KeyedTable:
        return KeyedTable(self.spark, self.root, spec, self.range_width)

    def create(self) -> None:
        """Make all tables anew with their seed rows; whatever they held is gone.

        The state is withdrawn first and its row written last: it tells that the
        rest is complete, so a reset that breaks off leaves no store.
        """
        self._state.clear()
        for table in (self.alert, self.alert_mitigations, self.ledger, self.alert_totals):
            table.create()
        self._totals_of.reset(self.alert_mitigations.in_use().revision)
        self._looked.reset({})
        self._pending.reset({})
        self.managed_object.create(seeds.seed_frame(self.spark, schemas.MANAGED_OBJECT_TABLE))
        for spec in (schemas.IMPORTANCE_TABLE, schemas.ALERT_TYPE_TABLE, schemas.SUBTYPE_TABLE):
            rows, path = seeds.seed_frame(self.spark, spec).coalesce(1), self._path(spec)
            write_checked(rows, spec, lambda r, to=path: r.write.mode("overwrite").parquet(to))
        self._state.reset(_noted(seeds.OPERATIONAL_INFO[0]))

    def exists(self) -> bool:
        """Whether the tables were created: the state row, written last, is there."""
        return self._state.take() is not None

    def table(self, spec: schemas.TableSpec) -> DataFrame:
        if spec == schemas.STATE_TABLE:
            return self.state()
        if spec.range_of is not None:
            return self._keyed(spec).read()
        return self.spark.read.schema(spec.schema).parquet(self._path(spec))

    def _path(self, spec: schemas.TableSpec) -> str:
        return f"{self.root}/{spec.name}"

    # State: one row, replaced as a whole, so a crash never loses the last good marks.

    def _log(self, name: str) -> RevisionLog:
        return RevisionLog(self.spark, f"{self.root}/{name}")

    @property
    def _state(self) -> RevisionLog:
        return self._log(schemas.STATE_TABLE.name)

    def state(self) -> DataFrame:
        found = self._state.take()
        rows = [_remembered(found[0])] if found else []
        return seeds.literal_rows(self.spark, rows, schemas.OPERATIONAL_INFO)

    def mark(self, field: str) -> datetime | None:
        """One load mark, by name; none where the state row is missing."""
        row = read_mark(self.state(), field).first()
        return row[0] if row else None

    def set_mark(self, field: str, moment: datetime) -> None:
        """Move a mark.  Moved back, it opens the batches behind it again."""
        if field not in MARKS:
            raise ValueError(f"no such mark: {field}")
        note, revision = self._state.take()
        row = dict(zip(schemas.STATE_TABLE.columns, _remembered(note)))
        before = row[field]
        if before is not None and moment < before:
            for kind in KINDS_OF[field]:
                self.open_again(kind, moment - times.LATE_ARRIVAL)
        self._state.append(_noted((row | {field: moment}).values()), revision + 1)

    def advance_mark(self, field: str, moment: datetime) -> None:
        """Move a mark forward; one that is further already stays."""
        before = self.mark(field)
        if before is None or moment > before:
            self.set_mark(field, moment)

    # The ledger of loaded batches, and what the landing zone held at the last look.

    @property
    def ledger(self) -> KeyedTable:
        return self._keyed(schemas.LEDGER_TABLE)

    def loaded_batches(self, kind: str) -> DataFrame:
        """batch_at of the batches of a kind that need not be read again."""
        return self.ledger.read().where((F.col("kind") == kind) & F.col("loaded")).select("batch_at")

    def record_batches(self, kind: str, batches: DataFrame, now: datetime, loaded: bool = True) -> None:
        """Enter batches (batch_at) as loaded, or as open again."""
        self.ledger.upsert(ledger_rows(batches, kind, now, loaded), ["loaded_at"])

    def open_again(self, kind: str, since: datetime) -> None:
        """Load the batches of a kind from a time on once more."""
        loaded = self.loaded_batches(kind).where(F.col("batch_at") >= times.ntz(since))
        self.record_batches(kind, loaded, since, loaded=False)
        self._note_listing(kind, {})

    @property
    def _looked(self) -> RevisionLog:
        return self._log("landing_dates")

    def known_listing(self, kind: str) -> Listing:
        """What dates of a kind held at the last look."""
        looked, _ = self._looked.take()
        return {
            date.fromisoformat(day) if day else None: tuple(size)
            for day, size in looked.get(kind, {}).items()
        }

    def remember_listing(self, kind: str, listing: Listing) -> None:
        """Note what dates of a kind held; the next load passes over those that hold no more."""
        if listing:
            self._note_listing(kind, self.known_listing(kind) | listing)

    def _note_listing(self, kind: str, listing: Listing) -> None:
        looked, revision = self._looked.take()
        looked[kind] = {str(day) if day else "": size for day, size in listing.items()}
        self._looked.append(looked, revision + 1)

    @property
    def _pending(self) -> RevisionLog:
        return self._log("pending_batches")

    def pending(self, checkpoint: str) -> tuple[int, set[datetime]]:
        """The last epoch a stream is done with (-1 for none), and the batches that wait in it."""
        streams, _ = self._pending.take()
        epoch, batches = streams.get(checkpoint, (-1, []))
        return epoch, {datetime.fromisoformat(b) for b in batches}

    def set_pending(self, checkpoint: str, epoch: int, batches: Iterable[datetime]) -> None:
        streams, revision = self._pending.take()
        streams[checkpoint] = (epoch, sorted(b.isoformat() for b in batches))
        self._pending.append(streams, revision + 1)

    def needs_initial_load(self) -> bool:
        return bool(self.state().select(needs_initial_load().alias("needed")).first()[0])

    # Totals of mitigations per alert, kept beside them.

    @property
    def alert_totals(self) -> KeyedTable:
        return self._keyed(schemas.TOTALS_TABLE)

    @property
    def _totals_of(self) -> RevisionLog:
        return self._log("alert_totals_of")

    def upsert_mitigations(
        self,
        rows: DataFrame,
        arrival: Sequence[str],
        only_later: bool = False,
        widen: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        derive: Mapping[str, Column] | None = None,
    ) -> None:
        """Upsert mitigations, and renew the totals of the alerts they belong or belonged to."""
        followed = self.totals() is not None
        change = self.alert_mitigations.upsert(rows, arrival, only_later, widen, derive)
        if not followed:
            self.rebuild_totals()
        elif change is not None:
            self._renew_totals(change)
            self._follow()

    def rebuild_totals(self) -> None:
        """Make the totals of all alerts anew, as after a change of lookup rows."""
        every = self.alert_mitigations.in_use().ranges
        rows = self.alert_mitigations.read_ranges(every).where("alert_id is not null")
        self.alert_totals.create(views.kept_totals(rows, self.dimensions(), RANGE))
        self._follow()

    def _renew_totals(self, change: Change) -> None:
        """Add up anew what the touched alerts have, reading the ranges that may hold it."""
        places = change.stored.select("alert_id", RANGE)
        if change.replaced is not None:
            places = places.unionByName(change.replaced.select("alert_id", RANGE))
        path = f"{self.root}/_staging/touched_alerts"
        places.where("alert_id is not null").distinct().write.mode("overwrite").parquet(path)
        places = self.spark.read.schema(places.schema).parquet(path)
        touched = places.select("alert_id").distinct()
        before = self.alert_totals.read_ranges(self.alert_totals.ranges_of(touched))
        held = before.join(touched, "alert_id", "left_semi").select(F.explode("key_ranges"))
        ranges = [row[0] for row in places.select(RANGE).union(held).distinct().collect()]
        rows = self.alert_mitigations.read_ranges(ranges).join(touched, "alert_id", "left_semi")
        renewed = views.kept_totals(rows, self.dimensions(), RANGE)
        # An alert may have lost its last mitigation to another one.
        self.alert_totals.upsert(touched.join(renewed, "alert_id", "left"), ["n_mitigations"])

    def _follow(self) -> None:
        """Note which revision of the mitigations the totals belong to."""
        _, revision = self._totals_of.take()
        self._totals_of.append(self.alert_mitigations.in_use().revision, revision + 1)

    def totals(self) -> DataFrame | None:
        """The kept totals; none where they do not belong to the mitigations as they are."""
        if self._totals_of.take()[0] != self.alert_mitigations.in_use().revision:
            return None
        return self.alert_totals.read().where("n_mitigations > 0").drop("n_mitigations", "key_ranges")

    # Views.

    def dimensions(self) -> views.Dimensions:
        return views.Dimensions(
            self.table(schemas.IMPORTANCE_TABLE),
            self.table(schemas.ALERT_TYPE_TABLE),
            self.table(schemas.SUBTYPE_TABLE),
            self.managed_object.read(),
        )

    def views(self) -> dict[str, DataFrame]:
        return views.all_views(
            self.alert.read(),
            self.alert_mitigations.read(),
            self.dimensions(),
            self.state(),
            self.totals(),
        )

    def register(self) -> None:
        """Offer all tables and views to SQL in this session."""
        for spec in schemas.TABLES:
            self.table(spec).createOrReplaceTempView(spec.name)
        for name, view in self.views().items():
            view.createOrReplaceTempView(name)


def _noted(values: Iterable) -> list:
    """A state row as JSON has it."""
    row = list(values)
    missing = [f.name for f, value in zip(schemas.STATE_TABLE.schema, row) if value is None and not f.nullable]
    if missing:
        raise ConstraintError(f"{schemas.STATE_TABLE.name}: null {missing[0]}")
    return [value.isoformat() if isinstance(value, datetime) else value for value in row]


def _remembered(note: list) -> tuple:
    return tuple(datetime.fromisoformat(v) if isinstance(v, str) else v for v in note)


def read_mark(state: DataFrame, field: str) -> DataFrame:
    if field not in MARKS:
        raise ValueError(f"no such mark: {field}")
    return state.where(F.col("id") == seeds.STATE_ID).select(field)


def move_mark(state: DataFrame, field: str, moment: datetime) -> DataFrame:
    """The state with one mark moved, for the one row in use."""
    if field not in MARKS:
        raise ValueError(f"no such mark: {field}")
    in_use = F.col("id") == seeds.STATE_ID
    return state.withColumn(field, F.when(in_use, times.ntz(moment)).otherwise(F.col(field)))


def ledger_rows(batches: DataFrame, kind: str, now: datetime, loaded: bool = True) -> DataFrame:
    """Rows of the ledger for some batches."""
    # The time comes first, as its date tells the key range.
    return batches.select("batch_at").distinct().select(
        F.concat_ws(" ", F.col("batch_at").cast("string"), F.lit(kind)).alias("id"),
        F.lit(kind).alias("kind"),
        "batch_at",
        F.lit(loaded).alias("loaded"),
        times.ntz(now).alias("loaded_at"),
    )


def needs_initial_load():
    """Column over the state row: either mark was never moved."""
    first, second = (times.never_loaded(F.col(mark)) for mark in MARKS)
    return first | second
