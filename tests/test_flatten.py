from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import (
    NOW, alert, blackhole_rates, by_id, detail, device_rates, flowspec_rates, page, put, unit_value,
)
from floodmark import schemas
from floodmark.plans import flatten, loads
from floodmark.sources import landing as landed

STATS = ("average", "max", "timeseries", "timeseries_start", "step")


def alert_rows(landing):
    return by_id(flatten.flatten_alerts(loads.collections(landing), NOW))


def mitigation_rows(landing):
    details = flatten.latest_details(landing.accepted("mitigations"))
    rows = loads.mitigation_rows(
        loads.collections(landing), details, loads.landed_rates(landing), NOW
    )
    return by_id(rows)


def test_alert_columns(landing):
    put(landing, "alerts", page(alert(7)))
    rows = flatten.flatten_alerts(loads.collections(landing), NOW)
    assert rows.columns == [*schemas.ALERT_TABLE.columns, "batch_at", "page", "pos"]
    row = rows.first()
    assert row["id"] == 7
    assert row["start_time"] == datetime(2024, 5, 1, 10)
    assert row["stop_time"] == datetime(2024, 5, 1, 11)
    assert row["countries"] == ["DE"] and row["protocols"] == ["udp"]
    assert row["managed_object_id"] == 1
    assert row["last_updated"] == NOW
    types = dict(rows.dtypes)
    assert all(types[f.name] == f.dataType.simpleString() for f in schemas.ALERT_TABLE.schema)


def test_optional_fields(landing):
    optional = ("countries", "host_address", "impact_boundary", "impact_bps", "impact_pps",
                "misuse_types", "protocols", "stop_time", "fast_detected")
    put(landing, "alerts", page(alert(1, **{name: None for name in optional}), alert(2)))
    row = alert_rows(landing)[1]
    assert row["fast_detected"] is False
    assert all(row[name] is None for name in optional if name != "fast_detected")


def test_owner_falls_back_to_global_detection(landing):
    settings = {"global_detection_settings": {"data": {"id": "5"}}}
    put(landing, "alerts", page(
        alert(1, owner=None, relationships=settings), alert(2, owner="8", relationships=settings)
    ))
    rows = alert_rows(landing)
    assert (rows[1]["managed_object_id"], rows[2]["managed_object_id"]) == (71, 8)


def test_owner_of_nothing_fails_or_is_null(landing):
    put(landing, "alerts", page(alert(1, owner=None)))
    alerts = loads.collections(landing)
    with pytest.raises(Exception, match="without managed object"):
        flatten.flatten_alerts(alerts, NOW).collect()
    assert flatten.flatten_alerts(alerts, NOW, strict=False).first()["managed_object_id"] is None


def test_object_and_array_replies(landing):
    put(landing, "alerts", page(alert(1), alert(2)))
    put(landing, "alerts_by_id", {"batch_at": "2024-05-02T00:00:00", "data": alert(3), "meta": {}})
    single = landed.single_elements(landing.accepted("alerts_by_id"))
    both = loads.collections(landing).unionByName(single)
    assert sorted(int(r[0]) for r in both.select("doc.id").collect()) == [1, 2, 3]


def test_rejected_replies_contribute_nothing(landing):
    good = {"batch_at": "2024-05-02T00:00:00", "data": alert(3)}
    odd = {"batch_at": "2024-05-02T00:00:00", "data": alert(4, importance="high")}
    put(landing, "alerts_by_id", good, odd, {"errors": [{"status": "404"}]}, '{"data": {"id": "9"')
    replies = landed.reply_outcome(landing.documents("alerts_by_id"))
    counts = {r["outcome"]: r["count"] for r in replies.groupBy("outcome").count().collect()}
    assert counts == {"accepted": 1, "partial": 1, "refused": 1, "broken": 1}
    assert landing.accepted("alerts_by_id").count() == 2


def test_folders_never_landed_are_empty(landing):
    assert loads.collections(landing).count() == 0
    assert mitigation_rows(landing) == {}


def test_page_completeness(landing):
    put(landing, "alerts", page(alert(1), number=1, total=2), page(alert(2), number=2, total=2))
    put(landing, "alerts", page(alert(3), number=1, total=2, batch="2024-05-03T00:00:00"), name="b")
    put(landing, "alerts", {"batch_at": "2024-05-04T00:00:00", "data": [alert(4)], "meta": {}}, name="c")
    found = landed.page_completeness(landing.accepted("alerts")).orderBy("batch_at").collect()
    assert [(r["pages_announced"], r["pages_seen"], r["complete"]) for r in found] == [
        (2, 2, True), (2, 1, False), (1, 1, True),
    ]


def test_batches_are_skipped_by_date(landing):
    for day in (1, 2, 3):
        put(landing, "alerts", page(alert(day), batch=f"2024-05-0{day}T06:00:00"), date=f"2024-05-0{day}")
    recent = landing.accepted("alerts", datetime(2024, 5, 2))
    assert sorted(r[0][0]["id"] for r in recent.select("data").collect()) == ["2", "3"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "batch_date" in plan.split("PartitionFilters: [")[1]


def test_device_rates(landing):
    put(landing, "alerts", page(alert(1, ["tms-1", "tms-2", "tms-3"])))
    put(landing, "mitigations", *[detail(f"tms-{n}", 1) for n in (1, 2, 3)])
    put(landing, "device_rates",
        device_rates("tms-1", 1, bps=[8.0, None, 16.0], pps=None),
        {"batch_at": "2024-05-02T00:00:00", "alert_id": "1", "mitigation_id": "tms-2", "data": {}})
    rows = mitigation_rows(landing)
    one = rows["1_tms-1"]
    assert one["r_drop_bps_sum"] == 24.0 * 60
    assert one["r_drop_bps_timeseries_start"] == datetime(2024, 5, 1, 10, 5)
    # Averages and maxima stay, start and step only come with a series.
    assert (one["r_drop_pps_avg"], one["r_drop_pps_max"]) == (1.0, 2.0)
    assert one["r_drop_pps_step"] is None and one["r_drop_pps_timeseries_start"] is None
    assert one["r_drop_pps_sum"] is None
    for other in ("1_tms-2", "1_tms-3"):
        assert rows[other]["r_drop_bps_avg"] is None and rows[other]["r_drop_bps_sum"] is None


def test_flowspec_rates(landing):
    ids = ["flowspec-1", "flowspec-2", "flowspec-3"]
    put(landing, "alerts", page(alert(1, ids)))
    put(landing, "mitigations", *[detail(i, 1, "flowspec") for i in ids])
    put(landing, "flowspec_rates",
        flowspec_rates(1, "bps", [
            ("flowspec-1", unit_value("bps", [1.0], top=4.0)),
            ("flowspec-1", unit_value("bps", [2.0], top=5.0)),
            ("flowspec-9", unit_value("bps", [7.0])),
        ]),
        flowspec_rates(1, "pps", [
            ("flowspec-1", unit_value("pps", [3.0])), ("flowspec-2", unit_value("pps", [4.0])),
        ]))
    rows = mitigation_rows(landing)
    assert set(rows) == {f"1_{i}" for i in ids}
    # The last entry of a mitigation counts.
    assert (rows["1_flowspec-1"]["r_drop_bps_max"], rows["1_flowspec-1"]["r_drop_bps_sum"]) == (5.0, 120.0)
    assert rows["1_flowspec-1"]["r_drop_pps_sum"] == 180.0
    assert rows["1_flowspec-2"]["r_drop_bps_sum"] is None
    assert rows["1_flowspec-2"]["r_drop_pps_sum"] == 240.0
    assert rows["1_flowspec-3"]["r_drop_pps_max"] is None


def test_blackhole_rates_get_a_row_of_their_own(landing):
    ids = ["tms-1", "blackhole-5", "blackhole-4"]
    put(landing, "alerts", page(alert(1, ids)))
    put(landing, "mitigations",
        detail("tms-1", 1), detail("blackhole-5", 1, "blackhole"), detail("blackhole-4", 1, "blackhole"))
    put(landing, "blackhole_rates",
        blackhole_rates(1, "bps", [
            ("misuse_types-7", unit_value("bps", [1.0])),
            ("misuse_types-71", unit_value("bps", [2.0])),
            ("misuse_types-8", unit_value("bps", [3.0])),
        ]),
        blackhole_rates(1, "pps", [("misuse_types-8", unit_value("pps", [4.0]))]))
    rows = mitigation_rows(landing)
    assert set(rows) == {"1_tms-1", "1_blackhole-5", "1_blackhole-4", "1_blackhole-fake4rates-1"}
    made_up = rows["1_blackhole-fake4rates-1"]
    # Details of the first blackhole in the list, rates of the last matching entry.
    assert made_up["name"] == "name of blackhole-5" and made_up["subtype"] == "blackhole"
    assert made_up["r_drop_bps_sum"] == 120.0 and made_up["r_drop_pps_sum"] is None
    assert all(rows[f"1_{i}"]["r_drop_bps_max"] is None for i in ids[1:])


def test_blackhole_without_rates_still_has_its_row(landing):
    put(landing, "alerts", page(alert(1, ["blackhole-5"])))
    put(landing, "mitigations", detail("blackhole-5", 1, "blackhole"))
    rows = mitigation_rows(landing)
    assert set(rows) == {"1_blackhole-5", "1_blackhole-fake4rates-1"}


def test_the_last_method_named_in_an_id_gives_the_rates(landing):
    put(landing, "alerts", page(alert(1, ["tms-flowspec-1", "other-1"])))
    put(landing, "mitigations", detail("tms-flowspec-1", 1), detail("other-1", 1, "other"))
    put(landing, "device_rates", device_rates("tms-flowspec-1", 1, bps=[1.0], pps=[1.0]))
    rows = mitigation_rows(landing)
    # A flowspec by name, without flowspec rates; unclassified ids keep their row.
    assert rows["1_tms-flowspec-1"]["r_drop_bps_sum"] is None
    assert rows["1_other-1"]["r_drop_bps_sum"] is None


def test_mitigation_listed_by_two_alerts(landing):
    put(landing, "alerts", page(alert(1, ["tms-1"]), alert(2, ["tms-1"])))
    put(landing, "mitigations", detail("tms-1", 1))
    put(landing, "device_rates", device_rates("tms-1", 1, [1.0], [1.0]), device_rates("tms-1", 2, [2.0], [2.0]))
    rows = mitigation_rows(landing)
    # Two keys, but both on the alert the mitigation itself names.
    assert {k: (r["alert_id"], r["r_drop_bps_sum"]) for k, r in rows.items()} == {
        "1_tms-1": (1, 60.0), "2_tms-1": (1, 120.0),
    }


def test_repeated_alert_counts_with_its_last_list(landing):
    put(landing, "alerts",
        page(alert(1, ["tms-1"]), alert(1, ["tms-2"]), number=1, total=2),
        page(alert(1), number=2, total=2))
    put(landing, "mitigations", detail("tms-1", 1), detail("tms-2", 1))
    assert set(mitigation_rows(landing)) == {"1_tms-2"}


def test_repeated_ids_and_details(landing):
    put(landing, "alerts", page(alert(1, ["tms-1", "tms-1"])))
    put(landing, "mitigations",
        detail("tms-1", 1, name="old"), detail("tms-1", 1, number=2, name="new"))
    rows = mitigation_rows(landing)
    assert [r["name"] for r in rows.values()] == ["new"]


def test_missing_detail_leaves_no_row(landing):
    put(landing, "alerts", page(alert(1, ["tms-1", "tms-2"])))
    put(landing, "mitigations", detail("tms-1", 1, user=None, stop=None))
    rows = mitigation_rows(landing)
    assert set(rows) == {"1_tms-1"}
    assert rows["1_tms-1"]["stop"] is None
    pairs = flatten.with_details(
        flatten.mitigation_pairs(loads.collections(landing)), landing.accepted("mitigations")
    )
    assert pairs.where(F.col("detail").isNull()).count() == 1


def test_load_stats(landing):
    put(landing, "alerts", page(alert(1, ["tms-1"]), alert(2), alert(3, [])))
    stats = loads.load_stats(loads.collections(landing)).first()
    assert (stats["alerts"], stats["alerts_with_mitigations"]) == (3, 2)
