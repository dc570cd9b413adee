"""Tables kept unique by key, stored as Parquet in key ranges.

A table is a folder per range of keys, with a folder per version in it.  Ids grow with
time, so a load touches the newest ranges and the few older ones that still hold open
alerts.  Of a touched range only those files are written anew that hold a key of the
batch: what else they hold goes into the new version, beside the batch.

One small note says which versions of which ranges are in use, and which of their files
are not any more.  It is replaced last, so a load that breaks off has changed nothing,
and readers see the table before or after an upsert.  Versions that went out of use
stay for as long as the last revisions of that note name them; views made meanwhile
answer from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.operators.constraints import write_checked
from floodmark.operators.latest import first_per_key, latest_per_key
from floodmark.operators.revisions import KEPT, RevisionLog
from floodmark.schemas import TableSpec
from floodmark.seeds import literal_rows
from floodmark.session import SHUFFLES_LET_GO, settings
from floodmark.sources import folders

RANGE, VERSION, FILE = "key_range", "version", "file"
DEFAULT_RANGE_WIDTH = 1_000_000
COMPRESSION = "zstd"
# A range of so many versions is written anew as a whole, small files and all.
MOST_VERSIONS = 32

# The order of arrival, stored with every row that came with one.
ARRIVED = "_arrived"
ARRIVAL_TYPES = {"batch_at": "timestamp_ntz", "page": "int", "pos": "int", "list_pos": "int"}
_ARRIVED_TYPE = f"struct<{', '.join(f'{n}: {t}' for n, t in ARRIVAL_TYPES.items())}>"

# Which versions of a range are in use, and the names of their files that are not.
Parts = dict[int, set[str]]


@dataclass(frozen=True)
class InUse:
    """What the table consists of at one revision."""

    revision: int
    ranges: dict[int, Parts]

    def files_left_out(self) -> set[str]:
        return {name for parts in self.ranges.values() for names in parts.values() for name in names}

    def only(self, ranges: Iterable[int]) -> InUse:
        return InUse(self.revision, {r: self.ranges[r] for r in ranges if r in self.ranges})


@dataclass(frozen=True)
class Change:
    """What an upsert did: rows that are stored now, and the ones they replaced.

    To be read before the next upsert of the table.
    """

    stored: DataFrame
    replaced: DataFrame | None


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    root: str
    spec: TableSpec
    range_width: int = DEFAULT_RANGE_WIDTH

    @property
    def path(self) -> str:
        # The width is part of the path: opened with another width, a table is
        # simply not there, instead of holding the same key in two places.
        return f"{self.root}/{self.spec.name}/ranges_of_{self.range_width}"

    @property
    def staging_path(self) -> str:
        return f"{self.root}/_staging/{self.spec.name}"

    @property
    def _log(self) -> RevisionLog:
        return RevisionLog(self.spark, f"{self.root}/{self.spec.name}/in_use_{self.range_width}")

    def create(self, rows: DataFrame | None = None) -> None:
        """Make the table anew with the given rows or none, dropping whatever it held."""
        self._log.reset([])
        folders.remove(self.spark, self.path)
        held = []
        if rows is not None:
            first = self._ranged(rows, [], {}).withColumn(VERSION, F.lit(1).cast("bigint"))
            write_checked(
                first,
                self.spec,
                lambda r: r.write.partitionBy(RANGE, VERSION).parquet(self.path, compression=COMPRESSION),
            )
            held = folders.entries(self.spark, self.path)
        ranges = {int(one.name.split("=")[1]): {1: set()} for one in held if one.is_folder}
        self._put_in_use(InUse(1, ranges))

    def exists(self) -> bool:
        return self._log.take() is not None

    def read(self) -> DataFrame:
        """The rows as they are now; later changes do not show in the frame."""
        return self._stored(self.in_use()).select(*self.spec.columns)

    def ranges_of(self, keys: DataFrame) -> list[int]:
        """The key ranges of some keys, whether stored or not."""
        key_range = F.expr(f"cast({self.spec.range_of} div {self.range_width} as bigint)")
        return [row[0] for row in keys.select(key_range).distinct().collect()]

    def read_ranges(self, ranges: Iterable[int]) -> DataFrame:
        """The rows of some key ranges, with the range of each."""
        return self._stored(self.in_use().only(ranges)).select(*self.spec.columns, RANGE)

    def upsert(
        self,
        batch: DataFrame,
        arrival: Sequence[str],
        only_later: bool = False,
        widen: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        derive: Mapping[str, Column] | None = None,
    ) -> Change | None:
        """Replace or add whole rows by key; the last arrival of a key wins.

        With ``only_later`` that holds for stored rows too: a row of the batch gives
        way to a stored one that arrived after it.  Repeating an upsert changes
        nothing.  ``widen`` adds columns to the rows that win within the batch, so that
        wide ones take no part in choosing them.  ``derive`` are columns of the table that
        follow from others of the same row of the batch: they are made as the rows are
        written, and neither staged nor shuffled.  Returns none for an empty batch.

        Keys and places of stored rows in the batch's ranges meet the batch first; Spark
        broadcasts a small batch there.  Then the files that hold some of its keys are
        read, and no others.
        """
        derive = derive or {}
        staged = self._stage(widen(latest_per_key(batch, [self.spec.key], arrival)), arrival, derive)
        touched = self._ranges_in(staged)
        now = self.in_use()
        there = now.only(touched)
        hit: dict[int, Parts] = {}
        fresh, kept, replaced = staged, None, None
        if not touched:
            return None
        if there.ranges:
            met = self._met(staged, there)
            places = met.select(RANGE, VERSION, FILE, "stale").distinct().collect()
            if only_later and any(row.stale for row in places):
                fresh = without_keys(staged, met.where("stale"), self.spec.key)
            for row in places:
                if not (only_later and row.stale):
                    hit.setdefault(row[0], {}).setdefault(row[1], set()).add(row[2])
            for key_range, parts in there.ranges.items():
                if len(parts) >= MOST_VERSIONS:
                    hit[key_range] = self._files({key_range: parts})[key_range]
            if hit:
                names = [name for parts in hit.values() for files in parts.values() for name in files]
                old = self._stored(there.only(hit)).where(_file_name().isin(names))
                kept = without_keys(old, fresh, self.spec.key)
                replaced = old.join(fresh.select(self.spec.key), self.spec.key, "left_semi")
        stored = self._whole(fresh, derive)
        if kept is not None:
            kept = kept.select(*stored.columns)
        if derive:
            rows = self._whole(_by_range(fresh), derive)
            rows = rows if kept is None else _by_range(kept).unionByName(rows)
        else:
            rows = _by_range(stored if kept is None else kept.unionByName(stored))
        self._add_version(now, rows, touched, hit)
        return Change(stored, replaced)

    def insert_absent(self, batch: DataFrame, arrival: Sequence[str] | None = None) -> None:
        """Add the rows whose key is not stored yet; stored rows stay as they are."""
        fresh = first_per_key(batch, [self.spec.key], arrival or [self.spec.key])
        now = self.in_use()
        absent = without_keys(fresh, self._stored(now), self.spec.key)
        staged = self._stage(absent, arrival or [], {})
        self._add_version(now, _by_range(staged), self._ranges_in(staged), {})

    # Versions.

    def in_use(self) -> InUse:
        found = self._log.take()
        if found is None:
            raise LookupError(f"{self.spec.name} was never created at {self.path}")
        ranges, revision = found
        return InUse(revision, {r: {v: set(without) for v, without in parts} for r, parts in ranges})

    def files(self) -> list[str]:
        """Names of the files in use."""
        found = self._files(self.in_use().ranges)
        return sorted(n for parts in found.values() for names in parts.values() for n in names)

    def _files(self, ranges: dict[int, Parts]) -> dict[int, Parts]:
        return {
            r: {v: self._names(r, v) - without for v, without in parts.items()}
            for r, parts in ranges.items()
        }

    def _names(self, key_range: int, version: int) -> set[str]:
        held = folders.entries(self.spark, self._folder(key_range, version))
        return {one.name for one in held if not one.is_folder}

    def _folder(self, key_range: int, version: int) -> str:
        return f"{self.path}/{RANGE}={key_range}/{VERSION}={version}"

    def _add_version(
        self, now: InUse, rows: DataFrame, touched: list[int], replaced: dict[int, Parts]
    ) -> None:
        """Write rows as the next version, then put it in use in place of some files."""
        version = now.revision + 1
        for key_range in touched:
            # A load that broke off may have written under this number.
            folders.remove(self.spark, self._folder(key_range, version))
        self._write(rows, version)
        ranges = {r: {v: set(n) for v, n in parts.items()} for r, parts in now.ranges.items()}
        for key_range, parts in replaced.items():
            for old, names in parts.items():
                ranges[key_range][old] |= names
                if ranges[key_range][old] >= self._names(key_range, old):
                    del ranges[key_range][old]
        for key_range in touched:
            if self._names(key_range, version):
                ranges.setdefault(key_range, {})[version] = set()
        found = InUse(version, ranges)
        self._put_in_use(found)
        self._clear(touched, found)

    def _write(self, rows: DataFrame, version: int) -> None:
        """Write rows, laid out by range, to their key ranges."""
        with settings(self.spark, SHUFFLES_LET_GO):
            (
                rows.withColumn(VERSION, F.lit(version).cast("bigint"))
                .write.mode("append")
                .partitionBy(RANGE, VERSION)
                .parquet(self.path, compression=COMPRESSION)
            )

    def _put_in_use(self, found: InUse) -> None:
        ranges = [
            (r, [(v, sorted(names)) for v, names in sorted(parts.items())])
            for r, parts in sorted(found.ranges.items())
        ]
        self._log.append(ranges, found.revision)

    def _clear(self, ranges: list[int], found: InUse) -> None:
        """Remove versions of some ranges that no kept revision names, once there are many."""
        held = {
            (r, int(one.name.split("=")[1]))
            for r in ranges
            for one in folders.entries(self.spark, f"{self.path}/{RANGE}={r}")
        }
        in_use = {(r, v) for r, parts in found.ranges.items() for v in parts}
        if len(held - in_use) <= KEPT * len(ranges):
            return
        named = {
            (r, version)
            for ranges_then in self._log.all()
            for r, parts in ranges_then
            for version, _ in parts
        }
        for key_range, version in held - named:
            folders.remove(self.spark, self._folder(key_range, version))

    # Rows.

    def _stored(self, found: InUse) -> DataFrame:
        """The rows of some versions; files that are left out are never opened."""
        schema = f"{self.spec.ddl}, {ARRIVED} {_ARRIVED_TYPE}, {RANGE} bigint, {VERSION} bigint"
        paths = [self._folder(r, v) for r, parts in found.ranges.items() for v in parts]
        if not paths:
            return literal_rows(self.spark, [], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
        left_out = sorted(found.files_left_out())
        return rows.where(~_file_name().isin(left_out)) if left_out else rows

    def _met(self, staged: DataFrame, there: InUse) -> DataFrame:
        """Stored rows with keys of the batch: their file, and whether they arrived after it."""
        key = self.spec.key
        stored = self._stored(there).select(
            key, RANGE, VERSION, _file_name().alias(FILE), F.col(ARRIVED).alias("before")
        )
        stale = F.coalesce(F.col("before") > F.col(ARRIVED), F.lit(False)).alias("stale")
        return stored.join(staged.select(key, ARRIVED), key).select(key, RANGE, VERSION, FILE, stale)

    def _ranged(
        self, rows: DataFrame, arrival: Sequence[str], derive: Mapping[str, Column]
    ) -> DataFrame:
        """Rows with their order of arrival and range; instead of derived columns what those need."""
        key = self.spec.key
        own = [c for c in self.spec.columns if c not in derive]
        needed = [c for c in rows.columns if c not in self.spec.columns] if derive else []
        key_range = F.expr(f"cast({self.spec.range_of} div {self.range_width} as bigint)")
        return (
            rows.select(*own, *needed, _arrived(arrival).alias(ARRIVED))
            .withColumn(key, F.col(key).cast(self.spec.schema[key].dataType))
            .withColumn(RANGE, key_range)
        )

    def _whole(self, ranged: DataFrame, derive: Mapping[str, Column]) -> DataFrame:
        """All columns as they are stored."""
        columns = [derive.get(c, F.col(c)).alias(c) for c in self.spec.columns]
        return ranged.select(*columns, ARRIVED, RANGE)

    def _stage(
        self, rows: DataFrame, arrival: Sequence[str], derive: Mapping[str, Column]
    ) -> DataFrame:
        """Write the batch once beside the table and read it back.

        The batch is computed a single time, its true size is known to the
        planner, and a lost executor costs a re-read instead of a recompute.  Rows
        that lack required values are found by this write, and nothing is changed.
        """
        ranged = self._ranged(rows, arrival, derive)
        write_checked(
            ranged,
            self.spec,
            lambda r: r.write.mode("overwrite").parquet(self.staging_path, compression=COMPRESSION),
            derive,
        )
        return self.spark.read.schema(ranged.schema).parquet(self.staging_path)

    def _ranges_in(self, staged: DataFrame) -> list[int]:
        # As many values as there are ranges: for 32-bit ids and the default
        # width some two thousand at most.
        return [row[0] for row in staged.select(RANGE).distinct().collect()]


def _by_range(rows: DataFrame) -> DataFrame:
    """Rows laid out for writing: each range in few tasks of even size.

    A range that outgrows the others is split over several tasks.
    """
    return rows.hint("rebalance", F.col(RANGE))


def _file_name() -> Column:
    return F.col("_metadata.file_name")


def _arrived(arrival: Sequence[str]) -> Column:
    """The order of arrival as a struct that compares as it; null where there is none."""
    if not arrival or not set(arrival) <= set(ARRIVAL_TYPES):
        return F.lit(None).cast(_ARRIVED_TYPE)
    fields = [
        (F.col(name) if name in arrival else F.lit(None)).cast(kind).alias(name)
        for name, kind in ARRIVAL_TYPES.items()
    ]
    return F.struct(*fields)


def without_keys(rows: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur among the taken ones."""
    return rows.join(taken.select(key), key, "left_anti")
