from datetime import datetime, timedelta

import pytest

from conftest import NOW, alert, by_id, detail, device_rates, page, put
from floodmark import store as stores
from floodmark.plans import loads
from floodmark.store import Store
from floodmark.streaming.stream_load import load_epoch, stream_alerts

LATER = NOW + timedelta(days=1)


def land(landing, batch, name, classification):
    put(landing, "mitigations", *[detail(f"tms-{n}", n, batch=batch) for n in (1, 2)], name=name)
    put(landing, "device_rates",
        *[device_rates(f"tms-{n}", n, [float(n)], [1.0], batch=batch) for n in (1, 2)], name=name)
    alerts = [alert(n, [f"tms-{n}"], classification=classification) for n in (1, 2)]
    if name == "second":
        alerts = [alerts[1], alert(3, classification=classification)]
    put(landing, "alerts", page(*alerts, batch=batch), name=name)


def test_stream_equals_batch(spark, store, landing, tmp_path):
    store.create()

    def run():
        stream = stream_alerts(store, landing, str(tmp_path / "checkpoint"), clock=lambda: NOW)
        stream.awaitTermination()

    land(landing, NOW.isoformat(), "first", "old")
    run()
    assert set(by_id(store.alert.read())) == {1, 2}
    land(landing, LATER.isoformat(), "second", "new")
    run()
    run()  # nothing new

    whole = Store(spark, str(tmp_path / "batch"), range_width=10)
    whole.create()
    loads.load_alerts(whole, landing, loads.collections(landing), NOW)
    for table in ("alert", "alert_mitigations"):
        streamed, loaded = (by_id(getattr(s, table).read()) for s in (store, whole))
        assert streamed == loaded
    assert {i: r["classification"] for i, r in by_id(store.alert.read()).items()} == {
        1: "old", 2: "new", 3: "new",
    }
    assert store.mark(stores.ALERT_MARK) == NOW


def test_stream_of_single_replies(store, landing, tmp_path):
    store.create()
    put(landing, "alerts_by_id", {"batch_at": NOW.isoformat(), "data": alert(5)}, {"errors": []})
    stream_alerts(
        store, landing, str(tmp_path / "checkpoint"), kind="alerts_by_id", clock=lambda: NOW
    ).awaitTermination()
    assert set(by_id(store.alert.read())) == {5}


def test_stream_leaves_other_classes_to_nobody(store, landing, tmp_path):
    store.create()
    put(landing, "alerts", {"batch_at": NOW.isoformat(), "data": [alert(1), alert(2, alert_class="bgp")]})
    stream_alerts(store, landing, str(tmp_path / "checkpoint"), clock=lambda: NOW).awaitTermination()
    assert set(by_id(store.alert.read())) == {1}


def streamed(store, landing, checkpoint, now=NOW, **options):
    stream_alerts(store, landing, str(checkpoint), clock=lambda: now, **options).awaitTermination()


def test_a_page_before_its_details_waits(store, landing, tmp_path):
    """Nothing changes and the mark stands still; then the batch is loaded whole."""
    store.create()
    first = page(alert(1, ["tms-1"]), alert(2), total=2)
    put(landing, "alerts", first, page(alert(9), batch=LATER.isoformat()))
    streamed(store, landing, tmp_path / "checkpoint")
    assert set(by_id(store.alert.read())) == {9}
    assert store.mark(stores.ALERT_MARK).year == 1970
    put(landing, "alerts", page(alert(3), number=2, total=2), name="second")
    streamed(store, landing, tmp_path / "checkpoint")
    assert set(by_id(store.alert.read())) == {9}
    assert store.mark(stores.ALERT_MARK).year == 1970
    # The detail alone has the batch loaded.
    put(landing, "mitigations", detail("tms-1", 1))
    streamed(store, landing, tmp_path / "checkpoint", LATER)
    assert set(by_id(store.alert.read())) == {1, 2, 3, 9}
    assert set(by_id(store.alert_mitigations.read())) == {"1_tms-1"}
    assert store.mark(stores.ALERT_MARK) == LATER
    assert by_id(store.alert.read())[9]["last_updated"] == NOW


def test_replayed_epochs_change_nothing(store, landing, tmp_path):
    store.create()
    put(landing, "alerts", page(alert(1)))
    streamed(store, landing, tmp_path / "checkpoint")
    files = store.alert.files()
    met = {datetime.fromisoformat(page()["batch_at"])}
    # Once as the engine replays the last epoch, once by a stream that begins anew.
    load_epoch(store, landing, str(tmp_path / "checkpoint"), 0, met, "alerts", LATER)
    streamed(store, landing, tmp_path / "another", LATER)
    assert store.alert.files() == files
    assert by_id(store.alert.read())[1]["last_updated"] == NOW


def test_an_epoch_that_breaks_off_is_repeated(store, landing, tmp_path, monkeypatch):
    store.create()
    put(landing, "alerts", page(alert(1, ["tms-1"])))
    put(landing, "mitigations", detail("tms-1", 1))
    met = {datetime.fromisoformat(page()["batch_at"])}
    with monkeypatch.context() as broken:
        broken.setattr(Store, "record_batches", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_epoch(store, landing, "c", 0, met, "alerts", NOW)
    assert store.mark(stores.ALERT_MARK).year == 1970
    load_epoch(store, landing, "c", 0, met, "alerts", NOW)
    assert set(by_id(store.alert.read())) == {1}
    assert store.alert_mitigations.read().count() == 1
    assert store.pending("c") == (0, set()) and store.mark(stores.ALERT_MARK) == NOW


def test_a_stream_can_take_batches_as_they_are(store, landing, tmp_path):
    store.create()
    put(landing, "alerts", page(alert(1, ["tms-1"])))
    streamed(store, landing, tmp_path / "checkpoint", wait=False)
    assert set(by_id(store.alert.read())) == {1} and store.mark(stores.ALERT_MARK) == NOW
    put(landing, "mitigations", detail("tms-1", 1))
    streamed(store, landing, tmp_path / "checkpoint", wait=False)
    assert set(by_id(store.alert_mitigations.read())) == {"1_tms-1"}
