import random
from datetime import datetime
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from floodmark import schemas
from floodmark.operators import keyed_table, revisions
from floodmark.operators.keyed_table import KeyedTable
from floodmark.operators.latest import first_per_key, latest_per_key
from floodmark.operators.revisions import KEPT, RevisionLog

DDL = "id int, managed_object_name string, last_updated timestamp_ntz, seq int"
AT = datetime(2024, 1, 1)


@pytest.fixture
def table(spark, tmp_path):
    made = KeyedTable(spark, str(tmp_path), schemas.MANAGED_OBJECT_TABLE, range_width=10)
    made.create()
    return made


def batch(spark, *rows):
    return spark.createDataFrame([(i, name, AT, seq) for seq, (i, name) in enumerate(rows)], DDL)


def names(table):
    return {row["id"]: row["managed_object_name"] for row in table.read().collect()}


def test_upsert_replaces_adds_and_stores_nulls(spark, table):
    table.upsert(batch(spark, (1, "a"), (2, "b"), (25, "c")), ["seq"])
    table.upsert(batch(spark, (2, None), (3, "d")), ["seq"])
    assert names(table) == {1: "a", 2: None, 3: "d", 25: "c"}


def test_upsert_is_idempotent(spark, table):
    rows = batch(spark, (1, "a"), (12, "b"), (1, "c"))
    table.upsert(rows, ["seq"])
    table.upsert(rows, ["seq"])
    assert names(table) == {1: "c", 12: "b"}
    assert table.read().count() == 2


def test_only_touched_ranges_are_rewritten(spark, table):
    def files(key_range):
        return sorted(p.name for p in Path(table.path, f"key_range={key_range}").rglob("*.parquet"))

    table.upsert(batch(spark, (1, "a"), (12, "b")), ["seq"])
    untouched, touched = files(0), files(1)
    table.upsert(batch(spark, (13, "c")), ["seq"])
    assert files(0) == untouched
    assert files(1) != touched


def test_empty_batch_changes_nothing(spark, table):
    table.upsert(batch(spark, (1, "a")), ["seq"])
    table.upsert(batch(spark, (1, "b")).where("id > 5"), ["seq"])
    assert names(table) == {1: "a"}


def test_insert_absent_keeps_stored_rows_and_takes_the_first(spark, table):
    table.upsert(batch(spark, (1, "a")), ["seq"])
    table.insert_absent(batch(spark, (1, "b"), (2, "c"), (2, "d")), ["seq"])
    assert names(table) == {1: "a", 2: "c"}


def test_null_key_fails(spark, table):
    with pytest.raises(Exception, match="null id"):
        table.upsert(batch(spark, (None, "a")), ["seq"])


def test_other_width_does_not_see_the_table(spark, table):
    table.upsert(batch(spark, (1, "a")), ["seq"])
    assert table.exists()
    assert not KeyedTable(spark, table.root, table.spec, range_width=7).exists()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.text("abc", max_size=2)), max_size=20), st.randoms())
def test_last_wins_whatever_the_order_of_rows(spark, rows, rng: random.Random):
    numbered = [(key, value, seq) for seq, (key, value) in enumerate(rows)]
    shuffled = numbered[:]
    rng.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, "k int, v string, seq int")
    last = {row["k"]: row["v"] for row in latest_per_key(frame, ["k"], ["seq"]).collect()}
    first = {row["k"]: row["v"] for row in first_per_key(frame, ["k"], ["seq"]).collect()}
    assert last == {key: value for key, value in rows}
    assert first == {key: value for key, value in reversed(rows)}


def test_a_change_that_breaks_off_shows_the_old_rows(spark, table, monkeypatch):
    table.upsert(batch(spark, (1, "a"), (12, "b")), ["seq"])
    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "_put_in_use", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.upsert(batch(spark, (1, "x"), (2, "y"), (12, "z")), ["seq"])
    assert names(table) == {1: "a", 12: "b"}
    # What it wrote under the next version does not mix with what is written there now.
    table.upsert(batch(spark, (2, "c"), (12, "d")), ["seq"])
    assert names(table) == {1: "a", 2: "c", 12: "d"}


def test_a_registered_view_answers_after_changes(spark, table):
    table.upsert(batch(spark, (1, "a")), ["seq"])
    table.read().createOrReplaceTempView("as_it_was")
    for n in range(4):
        table.upsert(batch(spark, (1, f"b{n}"), (2, "c")), ["seq"])
    assert [r["managed_object_name"] for r in spark.sql("select * from as_it_was").collect()] == ["a"]
    assert names(table) == {1: "b3", 2: "c"}


def test_versions_nobody_names_are_removed(spark, table, monkeypatch):
    for module in (keyed_table, revisions):
        monkeypatch.setattr(module, "KEPT", 2)
    for n in range(8):
        table.upsert(batch(spark, (1, f"a{n}")), ["seq"])
    held = list(Path(table.path, "key_range=0").glob("version=*"))
    assert len(held) <= 3 and names(table) == {1: "a7"}


def test_files_of_a_touched_range_without_the_keys_stay(spark, table):
    table.upsert(batch(spark, (1, "a"), (2, "b")), ["seq"])
    old = set(table.files())
    table.upsert(batch(spark, (3, "c"), (4, "d")), ["seq"])
    new = set(table.files()) - old
    assert old < set(table.files())
    table.upsert(batch(spark, (4, "e")), ["seq"])
    assert old < set(table.files()) and not new & set(table.files())
    assert names(table) == {1: "a", 2: "b", 3: "c", 4: "e"}


def test_only_files_with_keys_of_the_batch_are_read(spark, table):
    """The plan of a read lists the folders in use and passes over files that are not."""
    table.upsert(batch(spark, *[(n, "old") for n in range(10)]).repartition(4), ["seq"])
    table.upsert(batch(spark, (3, "new")), ["seq"])
    in_use = table.in_use()
    left_out = in_use.files_left_out()
    read = {r[0] for r in table._stored(in_use).select("_metadata.file_name").distinct().collect()}
    assert not read & left_out and read == set(table.files())
    assert len(names(table)) == 10 and names(table)[3] == "new"


def test_ranges_of_many_versions_are_merged(spark, table, monkeypatch):
    monkeypatch.setattr(keyed_table, "MOST_VERSIONS", 3)
    for n in range(5):
        table.upsert(batch(spark, (n, f"a{n}")), ["seq"])
    assert len(table.in_use().ranges[0]) <= 3
    assert names(table) == {n: f"a{n}" for n in range(5)}


ARRIVAL = ["batch_at", "page"]


def arrived(spark, *rows):
    values = [(i, name, AT, datetime(2024, 1, day), number) for i, name, day, number in rows]
    return spark.createDataFrame(
        values, "id int, managed_object_name string, last_updated timestamp_ntz, batch_at timestamp_ntz, page int"
    )


def test_a_stored_row_gives_way_only_to_a_later_one(spark, table):
    table.insert_absent(batch(spark, (1, "seed"), (2, "seed")))
    table.upsert(arrived(spark, (1, "a", 5, 2), (3, "b", 5, 1)), ARRIVAL, only_later=True)
    assert names(table) == {1: "a", 2: "seed", 3: "b"}
    files = table.files()
    table.upsert(arrived(spark, (1, "older page", 5, 1), (3, "older", 4, 9)), ARRIVAL, only_later=True)
    assert names(table) == {1: "a", 2: "seed", 3: "b"} and table.files() == files
    table.upsert(arrived(spark, (1, "same again", 5, 2), (3, "older", 4, 9), (4, "c", 1, 1)), ARRIVAL, only_later=True)
    assert names(table) == {1: "same again", 2: "seed", 3: "b", 4: "c"}
    # Without the condition the batch wins whenever it arrived.
    table.upsert(arrived(spark, (1, "forced", 1, 1)), ARRIVAL)
    assert names(table)[1] == "forced"


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(0, 25), st.integers(1, 9), st.integers(1, 3)), max_size=6), max_size=4))
def test_upserts_equal_a_dictionary(spark, tmp_path_factory, batches):
    table = KeyedTable(spark, str(tmp_path_factory.mktemp("t")), schemas.MANAGED_OBJECT_TABLE, range_width=10)
    table.create()
    kept = {}
    for n, rows in enumerate(batches):
        table.upsert(arrived(spark, *[(i, f"{n} {day} {p}", day, p) for i, day, p in rows]), ARRIVAL, only_later=True)
        for i, day, p in sorted(rows, key=lambda r: (r[1], r[2])):
            if (day, p) >= kept.get(i, ((0, 0), ""))[0]:
                kept[i] = ((day, p), f"{n} {day} {p}")
    assert names(table) == {i: name for i, (_, name) in kept.items()}


def test_a_log_keeps_its_last_revisions(spark, tmp_path):
    log = RevisionLog(spark, str(tmp_path / "log"))
    assert log.take() is None
    log.reset([0])
    for n in range(1, 2_000):
        log.append([n], n)
    assert log.take() == ([1999], 1999)
    assert log.all() == [[n] for n in range(2_000 - KEPT, 2_000)]
    # A revision that broke off has a hidden name.
    Path(log.path, ".2000.json").write_text("{")
    assert log.take() == ([1999], 1999) and len(log.all()) == KEPT
    log.reset([7])
    assert log.all() == [[7]]


def test_derived_columns_are_made_as_rows_are_written(spark, table):
    def lines(*rows):
        return spark.createDataFrame([(i, part, seq) for seq, (i, part) in enumerate(rows)], "id int, part int, seq int")

    derive = {"managed_object_name": F.concat(F.lit("part "), "part"), "last_updated": F.lit(AT).cast("timestamp_ntz")}
    table.upsert(lines((1, 1), (1, 2), (25, 3), (2, 4)), ["seq"], derive=derive)
    staged = spark.read.parquet(table.staging_path).columns
    assert "part" in staged and "managed_object_name" not in staged
    change = table.upsert(lines((2, 5), (3, None)), ["seq"], derive=derive)
    assert names(table) == {1: "part 2", 2: "part 5", 3: None, 25: "part 3"}
    assert {r["id"]: r["managed_object_name"] for r in change.stored.collect()} == {2: "part 5", 3: None}
    assert [r["managed_object_name"] for r in change.replaced.collect()] == ["part 4"]


def test_missing_derived_values_fail(spark, tmp_path):
    made = KeyedTable(spark, str(tmp_path), schemas.LEDGER_TABLE)
    made.create()
    entries = spark.sql("select '2024-01-01 00:00:00 alerts' as id, 3 as seq, cast(null as string) as of")
    given = {"kind": F.col("of"), "batch_at": F.lit(AT), "loaded": F.lit(True), "loaded_at": F.lit(AT)}
    with pytest.raises(Exception, match="null kind"):
        made.upsert(entries, ["seq"], derive=given)
    assert made.read().count() == 0
