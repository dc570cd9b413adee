from datetime import datetime, timedelta

from conftest import NOW, alert, by_id, detail, device_rates, page, put
from floodmark import job
from floodmark import store as stores
from floodmark.plans import loads
from floodmark.store import Store
from floodmark.streaming.stream_load import utc_now


def managed_objects(*named, batch="2024-05-02T00:00:00"):
    data = [{"id": str(i), "attributes": {"name": name}} for i, name in named]
    return {"batch_at": batch, "page": 1, "data": data, "meta": {}}


def stamp(moment):
    return moment.isoformat() + "+00:00"


def test_initial_load(store, landing):
    store.create()
    start = NOW - timedelta(days=30)
    put(landing, "alerts", page(
        alert(1, ["tms-1"]),
        alert(2, start_time=stamp(start - timedelta(hours=1))),  # late, but within two hours
        alert(3, start_time=stamp(start - timedelta(hours=2))),  # not after the bound
        alert(4, alert_class="bgp"),
    ))
    put(landing, "mitigations", detail("tms-1", 1))
    put(landing, "device_rates", device_rates("tms-1", 1, [1.0], [2.0]))
    loads.initial_load(store, landing, NOW)
    assert set(by_id(store.alert.read())) == {1, 2}
    rows = by_id(store.alert_mitigations.read())
    assert rows["1_tms-1"]["r_drop_pps_sum"] == 120.0
    assert store.mark(stores.ALERT_MARK) == NOW
    assert store.mark(stores.MANAGED_OBJECT_MARK).year == 1970


def test_incremental_load_updates_and_adds(store, landing):
    store.create()
    put(landing, "alerts", page(alert(1, ["tms-1"], ongoing=True, stop_time=None)))
    put(landing, "mitigations", detail("tms-1", 1))
    put(landing, "device_rates", device_rates("tms-1", 1, [1.0], [2.0]))
    loads.initial_load(store, landing, NOW)
    later = NOW + timedelta(hours=1)
    batch = later.isoformat()
    put(landing, "alerts", page(
        # Started before the mark, but not by more than two hours.
        alert(1, ["tms-1"], start_time=stamp(NOW - timedelta(hours=1)), host_address=None),
        alert(2, start_time=stamp(NOW + timedelta(minutes=5))),
        batch=batch,
    ), name="second")
    put(landing, "mitigations", detail("tms-1", 1, batch=batch), name="second")
    loads.incremental_load(store, landing, later)
    rows = by_id(store.alert.read())
    assert set(rows) == {1, 2}
    assert rows[1]["ongoing"] is False and rows[1]["host_address"] is None
    assert rows[1]["last_updated"] == later
    # Rates were not landed again, so the newest row has none.
    assert by_id(store.alert_mitigations.read())["1_tms-1"]["r_drop_pps_sum"] is None
    assert store.mark(stores.ALERT_MARK) == later


def test_outage_longer_than_the_clamp(store, landing):
    """A clamped load loses alerts of a long outage; the default does not."""
    store.create()
    store.set_mark(stores.ALERT_MARK, NOW)
    later = NOW + timedelta(days=3)
    put(landing, "alerts", page(
        alert(1, start_time=stamp(NOW + timedelta(hours=1))),
        alert(2, start_time=stamp(later - timedelta(hours=25))),
        batch=later.isoformat(),
    ))
    loads.incremental_load(store, landing, later, max_minutes=loads.UPDATE_MINUTES)
    assert set(by_id(store.alert.read())) == {2}
    store.set_mark(stores.ALERT_MARK, NOW)
    loads.incremental_load(store, landing, later)
    assert set(by_id(store.alert.read())) == {1, 2}


def test_ongoing_alerts_close(store, landing):
    store.create()
    put(landing, "alerts", page(alert(1, ongoing=True, stop_time=None), alert(2)))
    loads.initial_load(store, landing, NOW)
    put(landing, "alerts_by_id",
        {"batch_at": NOW.isoformat(), "data": alert(1, classification="closed")},
        {"batch_at": NOW.isoformat(), "data": alert(2, classification="ignored")},
        {"batch_at": NOW.isoformat(), "data": alert(3)})
    loads.refresh_ongoing(store, landing, NOW + timedelta(minutes=1))
    rows = by_id(store.alert.read())
    assert set(rows) == {1, 2}
    assert (rows[1]["ongoing"], rows[1]["classification"]) == (False, "closed")
    assert rows[2]["classification"] == "Possible Attack"


def test_cycles(store, landing):
    put(landing, "alerts", page(alert(1, ongoing=True, stop_time=None)))
    put(landing, "managed_objects", managed_objects((10, "Dark"), (500, "Mine")))
    loads.run_cycle(store, landing, NOW)
    assert not store.needs_initial_load()
    names = by_id(store.managed_object.read())
    assert len(names) == 7
    assert names[10]["managed_object_name"] == "Dark" and names[10]["last_updated"] == NOW
    assert names[71]["managed_object_name"] == "Global Detection"

    later = NOW + timedelta(days=1)
    put(landing, "alerts", page(
        alert(1, start_time=stamp(NOW), classification="page", ongoing=True, stop_time=None),
        alert(2, start_time=stamp(NOW), ongoing=True, stop_time=None),
        batch=later.isoformat()), name="second")
    put(landing, "alerts_by_id",
        # Older than the page: must not win over it.
        {"batch_at": (NOW + timedelta(minutes=1)).isoformat(), "data": alert(1, classification="stale")},
        {"batch_at": (later + timedelta(minutes=1)).isoformat(), "data": alert(2, classification="own")})
    loads.run_cycle(store, landing, later)
    rows = by_id(store.alert.read())
    assert rows[1]["classification"] == "page" and rows[1]["ongoing"]
    assert rows[2]["classification"] == "own" and not rows[2]["ongoing"]
    before = sorted(store.alert.read().drop("last_updated").collect())
    loads.run_cycle(store, landing, later + timedelta(minutes=1))
    assert sorted(store.alert.read().drop("last_updated").collect()) == before


def test_window_start():
    mark = datetime(2024, 5, 1)
    assert loads.window_start(mark, NOW, None) == mark
    assert loads.window_start(mark, NOW, 60) == NOW - timedelta(minutes=60)
    assert loads.window_start(NOW, NOW, 60) == NOW


def test_job_runs_one_cycle(spark, store, landing):
    recent = stamp(utc_now().replace(microsecond=0) - timedelta(hours=1))
    put(landing, "alerts", page(alert(1, start_time=recent), alert(2)))
    words = ["--store", store.root, "--landing", landing.root]
    job.main([*words, "--initial-days", "1"])
    loaded = Store(spark, store.root)
    assert set(by_id(loaded.alert.read())) == {1}
    assert not loaded.needs_initial_load()
    job.main([*words, "--stream", f"{store.root}/checkpoint"])
    assert set(by_id(loaded.alert.read())) == {1, 2}


def test_gaps_wait_and_hold_the_mark(store, landing):
    store.create()
    put(landing, "alerts", page(alert(1, ["tms-1"]), alert(2)))
    assert loads.initial_load(store, landing, NOW) is False
    assert not by_id(store.alert.read()) and store.needs_initial_load()
    # Another batch is complete and is loaded at once.
    put(landing, "alerts", page(alert(3), batch="2024-05-02T06:00:00"), name="complete")
    assert loads.initial_load(store, landing, NOW) is False
    assert set(by_id(store.alert.read())) == {3}
    # The detail lands four hours late.
    put(landing, "mitigations", detail("tms-1", 1), name="late")
    assert loads.initial_load(store, landing, NOW + timedelta(hours=4)) is True
    assert set(by_id(store.alert.read())) == {1, 2, 3}
    assert store.mark(stores.ALERT_MARK) == NOW + timedelta(hours=4)


def test_a_missing_page_holds_a_later_mark_too(store, landing):
    store.create()
    store.set_mark(stores.ALERT_MARK, NOW - timedelta(hours=1))
    first = page(alert(1, start_time=stamp(NOW)), batch=NOW.isoformat())
    first["meta"] = {"pagination": {"totalPages": 2}}
    put(landing, "alerts", first)
    later = NOW + timedelta(hours=5)
    assert loads.incremental_load(store, landing, later) is False
    assert store.mark(stores.ALERT_MARK) == NOW - timedelta(hours=1)
    put(landing, "alerts", {**first, "page": 2, "data": [alert(2, start_time=stamp(NOW))]}, name="second")
    assert loads.incremental_load(store, landing, later) is True
    assert set(by_id(store.alert.read())) == {1, 2}
    assert store.mark(stores.ALERT_MARK) == later


def test_gaps_can_be_accepted(store, landing):
    store.create()
    put(landing, "alerts", page(alert(1, ["tms-1"])))
    assert loads.initial_load(store, landing, NOW, wait=False) is True
    assert set(by_id(store.alert.read())) == {1}


def test_a_batch_ten_hours_late_is_loaded_once(store, landing):
    store.create()
    put(landing, "alerts", page(alert(1), batch=NOW.isoformat()), date=str(NOW.date()))
    assert loads.initial_load(store, landing, NOW) is True
    later = NOW + timedelta(hours=12)
    put(landing, "alerts", page(alert(2, start_time=stamp(later)), batch=later.isoformat()),
        name="second", date=str(later.date()))
    assert loads.incremental_load(store, landing, later) is True
    # Fetched two hours after the first batch, landed ten hours later, with an old alert.
    late = (NOW + timedelta(hours=2)).isoformat()
    put(landing, "alerts", page(alert(3, ["tms-3"], start_time=stamp(NOW - timedelta(days=3))), batch=late),
        name="late", date=str(NOW.date()))
    put(landing, "mitigations", detail("tms-3", 3, batch=late), name="late", date=str(NOW.date()))
    assert loads.incremental_load(store, landing, later + timedelta(minutes=1)) is True
    assert set(by_id(store.alert.read())) == {1, 2, 3}
    assert set(by_id(store.alert_mitigations.read())) == {"3_tms-3"}
    stamps = {i: r["last_updated"] for i, r in by_id(store.alert.read()).items()}
    assert loads.incremental_load(store, landing, later + timedelta(minutes=2)) is True
    assert {i: r["last_updated"] for i, r in by_id(store.alert.read()).items()} == stamps


def test_a_late_page_of_managed_objects_is_loaded(store, landing):
    first = managed_objects((500, "Mine"))
    first["meta"] = {"pagination": {"totalPages": 2}}
    put(landing, "managed_objects", first)
    put(landing, "alerts", page(alert(1), batch=NOW.isoformat()))
    loads.run_cycle(store, landing, NOW)
    loads.run_cycle(store, landing, NOW + timedelta(days=1))
    assert store.needs_initial_load()
    assert by_id(store.managed_object.read())[500]["managed_object_name"] == "Mine"
    second = {**managed_objects((501, "Late")), "page": 2, "meta": {"pagination": {"totalPages": 2}}}
    put(landing, "managed_objects", second, name="late")
    now = NOW + timedelta(days=2)
    loads.run_cycle(store, landing, now)
    names = by_id(store.managed_object.read())
    assert names[501]["managed_object_name"] == "Late"
    assert store.mark(stores.MANAGED_OBJECT_MARK) == now
    loads.run_cycle(store, landing, now + timedelta(days=1))
    assert by_id(store.managed_object.read())[501]["last_updated"] == now


def test_dates_without_new_files_are_not_read_again(store, landing):
    store.create()
    for day in ("2024-05-01", "2024-05-02"):
        batch = f"{day}T06:00:00"
        put(landing, "alerts", page(alert(int(day[-2:])), batch=batch), date=day)
    loads.initial_load(store, landing, NOW)
    assert loads.unseen(store, landing, "alerts").listing == {}
    put(landing, "alerts", page(alert(9), batch="2024-05-01T07:00:00"), name="late", date="2024-05-01")
    look = loads.unseen(store, landing, "alerts")
    assert [str(day) for day in look.listing] == ["2024-05-01"]
    assert {r["batch_at"].hour for r in look.replies.collect()} == {7}
    # A batch with gaps keeps its own date open, and no other.
    put(landing, "alerts", page(alert(5, ["tms-5"]), batch="2024-05-02T08:00:00"), name="gap", date="2024-05-02")
    assert loads.incremental_load(store, landing, NOW) is False
    assert [str(day) for day in loads.unseen(store, landing, "alerts").listing] == ["2024-05-02"]


def test_a_mark_moved_back_opens_its_batches_again(store, landing):
    store.create()
    put(landing, "alerts", page(alert(1, start_time=stamp(NOW)), batch=NOW.isoformat()))
    loads.initial_load(store, landing, NOW)
    later = NOW + timedelta(hours=1)
    loads.incremental_load(store, landing, later)
    assert by_id(store.alert.read())[1]["last_updated"] == NOW
    store.set_mark(stores.ALERT_MARK, NOW - timedelta(hours=1))
    loads.incremental_load(store, landing, later)
    assert by_id(store.alert.read())[1]["last_updated"] == later


def test_an_older_reply_leaves_the_newer_row(store, landing):
    store.create()
    batch = (NOW - timedelta(hours=1)).isoformat()
    put(landing, "alerts", page(alert(1, ongoing=True, stop_time=None, classification="page"), batch=batch))
    loads.initial_load(store, landing, NOW)
    put(landing, "alerts_by_id",
        {"batch_at": (NOW - timedelta(hours=2)).isoformat(), "data": alert(1, classification="older")})
    loads.refresh_ongoing(store, landing, NOW)
    assert by_id(store.alert.read())[1]["classification"] == "page"
    put(landing, "alerts_by_id",
        {"batch_at": NOW.isoformat(), "data": alert(1, classification="newer")}, name="second")
    loads.refresh_ongoing(store, landing, NOW)
    row = by_id(store.alert.read())[1]
    assert row["classification"] == "newer" and not row["ongoing"]


def test_accepted_gaps_are_filled_later(store, landing):
    store.create()
    put(landing, "alerts", page(alert(1, ["tms-1"])))
    assert loads.initial_load(store, landing, NOW, wait=False) is True
    put(landing, "mitigations", detail("tms-1", 1))
    assert loads.incremental_load(store, landing, NOW + timedelta(hours=1), wait=False) is True
    assert set(by_id(store.alert_mitigations.read())) == {"1_tms-1"}
