import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from floodmark import schemas, seeds
from floodmark.plans import views

T0 = datetime(2024, 1, 1)
SUBTYPES = ["tms", "flowspec", "blackhole", "other", None]
TYPES = ["dos_host_detection", "dos_profiled_router", "dos_profiled_network", "unheard_of", None]


def some_alerts(rng, count):
    rows = []
    for n in range(count):
        ongoing = rng.random() < 0.3
        start = T0 + timedelta(seconds=rng.randrange(10**6), microseconds=rng.randrange(10**6))
        rows.append({
            "id": n, "alert_class": "dos", "alert_type": rng.choice(TYPES),
            "importance": rng.choice([0, 1, 2, 7, None]), "ongoing": ongoing,
            "start_time": start, "stop_time": None if ongoing else start + timedelta(seconds=90.25),
            "countries": rng.choice([None, [], ["DE", "FR"]]), "direction": rng.choice(["in", "out"]),
            "impact_bps": rng.choice([None, 5.0]), "managed_object_id": rng.choice([1, 10, 999, None]),
            "last_updated": T0 + timedelta(days=30, microseconds=600_000),
        })
    return rows


def some_mitigations(rng, count, alerts):
    number = lambda: rng.choice([None, float(rng.randrange(1000))])
    return [
        {
            "id": f"m{n}", "mitigation_id": f"x{n}", "alert_id": rng.randrange(alerts + 3) if rng.random() < 0.6 else 0,
            "subtype": rng.choice(SUBTYPES), "is_automitigation": rng.choice([True, False, None]),
            "r_drop_bps_sum": number(), "r_drop_pps_sum": number(),
            "r_drop_bps_max": number(), "r_drop_pps_max": number(),
        }
        for n in range(count)
    ]


def frame(spark, rows, spec):
    fields = spec.columns
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], spec.schema)


def managed_objects(spark):
    return seeds.seed_frame(spark, schemas.MANAGED_OBJECT_TABLE)


def brute_force(alerts, mitigations):
    """The report by plain loops."""
    importance, types = dict(seeds.ALERT_IMPORTANCE), dict(seeds.ALERT_TYPE)
    owners = {i: name for i, name, _ in seeds.MANAGED_OBJECT}
    labels = dict(seeds.MITIGATION_SUBTYPE)
    by_alert = defaultdict(list)
    for m in mitigations:
        if m["subtype"] in labels:
            by_alert[m["alert_id"]].append(m)
    report = {}
    for a in alerts:
        if a["importance"] not in importance or a["alert_type"] not in types:
            continue
        own = by_alert[a["id"]]
        row = {
            "alert_type_txt": types[a["alert_type"]],
            "importance_txt": importance[a["importance"]],
            "managed_object_name": owners.get(a["managed_object_id"], "unkown"),
            "impact_bps": a["impact_bps"] or 0.0,
            "impact_pps": 0.0,
            "mitigation_types": sorted({labels[m["subtype"]] for m in own}) or ["None"],
            "automitigation": any(m["is_automitigation"] for m in own),
            "mitigated": bool(own),
        }
        if a["stop_time"] is not None:
            row["duration"] = a["stop_time"] - a["start_time"]
        else:
            whole = lambda t: t.replace(microsecond=0) + timedelta(seconds=t.microsecond >= 500_000)
            row["duration"] = whole(a["last_updated"]) - whole(a["start_time"])
        values = {
            "r_drop_bps_max": lambda m: m["r_drop_bps_max"],
            "r_drop_pps_max": lambda m: m["r_drop_pps_max"],
            # round() takes halves to the even neighbour, as the report does.
            "r_drop_bytes": lambda m: None if m["r_drop_bps_sum"] is None else round(m["r_drop_bps_sum"] / 8),
            "r_drop_packets": lambda m: m["r_drop_pps_sum"],
        }
        for measure, value in values.items():
            for methods in (["tms"], ["flowspec"], ["blackhole"], ["tms", "flowspec"], ["tms", "flowspec", "blackhole"]):
                row[f"{measure}_{'_and_'.join(methods)}"] = sum(
                    value(m) or 0 for m in own if m["subtype"] in methods
                )
        report[a["id"]] = row
    return report


def test_report_equals_brute_force(spark):
    rng = random.Random(5)
    alerts = some_alerts(rng, 120)
    mitigations = some_mitigations(rng, 600, 120)
    dims = views.Dimensions.seeded(spark, managed_objects(spark))
    report = views.v_alert(
        frame(spark, alerts, schemas.ALERT_TABLE),
        frame(spark, mitigations, schemas.MITIGATION_TABLE), dims,
    )
    expected = brute_force(alerts, mitigations)
    found = {row["id"]: row.asDict() for row in report.collect()}
    assert set(found) == set(expected) and len(expected) > 30
    for id_, row in expected.items():
        assert {name: found[id_][name] for name in row} == row, id_
    subtypes = {r[0] for r in views.mitigation_subtype_list(report).collect()}
    assert subtypes == {name for row in expected.values() for name in row["mitigation_types"]}
    for view, column in views.FILTER_LISTS.items():
        listed = [r[0] for r in views.filter_list(report, column).collect()]
        assert sorted(listed) == sorted({found[i][column] for i in found}), view


def test_report_columns(spark):
    dims = views.Dimensions.seeded(spark, managed_objects(spark))
    report = views.v_alert(
        frame(spark, [], schemas.ALERT_TABLE), frame(spark, [], schemas.MITIGATION_TABLE), dims
    )
    assert len(report.columns) == 50
    types = dict(report.dtypes)
    assert types["start_time"] == types["stop_time"] == types["last_updated"] == "timestamp"
    assert types["duration"] == "interval day to second"
    assert types["mitigation_types"] == "array<string>"
    assert types["r_drop_bytes_tms_and_flowspec_and_blackhole"] == "decimal(38,0)"
    assert list(views.TOTALS)[:4] == [
        "r_drop_bps_max_tms", "r_drop_pps_max_tms", "r_drop_bps_max_flowspec", "r_drop_pps_max_flowspec",
    ]


def test_bytes_add_up_beyond_a_long(spark):
    rows = [
        {"id": f"m{n}", "alert_id": 1, "subtype": "tms", "r_drop_bps_sum": 8.0 * 2**62} for n in range(3)
    ]
    dims = views.Dimensions.seeded(spark, managed_objects(spark))
    alerts = frame(spark, [{"id": 1, "alert_type": TYPES[0], "importance": 1,
                            "start_time": T0, "last_updated": T0}], schemas.ALERT_TABLE)
    row = views.v_alert(alerts, frame(spark, rows, schemas.MITIGATION_TABLE), dims).first()
    assert row["r_drop_bytes_tms"] == 3 * 2**62


def test_added_method_names_show_up(spark):
    subtypes = seeds.literal_rows(
        spark, [*seeds.MITIGATION_SUBTYPE, ("other", "Another")], schemas.MITIGATION_SUBTYPE
    )
    seeded = views.Dimensions.seeded(spark, managed_objects(spark))
    dims = views.Dimensions(seeded.importance, seeded.alert_types, subtypes, seeded.managed_objects)
    alerts = frame(spark, [{"id": 1, "alert_type": TYPES[0], "importance": 1,
                            "start_time": T0, "last_updated": T0}], schemas.ALERT_TABLE)
    rows = [{"id": s, "alert_id": 1, "subtype": s} for s in ("other", "tms")]
    row = views.v_alert(alerts, frame(spark, rows, schemas.MITIGATION_TABLE), dims).first()
    assert row["mitigation_types"] == ["Another", "TMS"]
    assert row["r_drop_packets_tms"] == 0


def test_very_many_method_names(spark):
    many = [(f"s{n}", f"Name {n}") for n in range(300)]
    seeded = views.Dimensions.seeded(spark, managed_objects(spark))
    subtypes = seeds.literal_rows(spark, many, schemas.MITIGATION_SUBTYPE)
    dims = views.Dimensions(seeded.importance, seeded.alert_types, subtypes, seeded.managed_objects)
    rows = [{"id": s, "alert_id": 1, "subtype": s} for s, _ in many]
    totals = views.mitigation_totals(
        views.v_alert_mitigations(frame(spark, rows, schemas.MITIGATION_TABLE), dims)
    ).select(views.mitigation_types())
    assert totals.first()[0] == sorted(name for _, name in many)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_report(spark, tmp_path):
    """A report over Parquet tables, as at scale."""
    rng = random.Random(6)
    paths = {}
    for spec, rows in ((schemas.ALERT_TABLE, some_alerts(rng, 50)),
                       (schemas.MITIGATION_TABLE, some_mitigations(rng, 100, 50))):
        paths[spec] = str(tmp_path / spec.name)
        frame(spark, rows, spec).write.parquet(paths[spec])
    alerts, mitigations = (spark.read.parquet(p) for p in paths.values())
    return views.v_alert(alerts, mitigations, views.Dimensions.seeded(spark, managed_objects(spark)))


def test_report_reads_no_series_and_shuffles_each_side_once(stored_report):
    text = plan(stored_report)
    assert "timeseries" not in text
    assert text.count("Exchange hashpartitioning") <= 2
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "SortAggregate" not in text


def test_filter_lists_skip_the_mitigations(stored_report):
    for column in views.FILTER_LISTS.values():
        text = plan(views.filter_list(stored_report, column))
        assert text.count("FileScan parquet") == 1, column
        assert "r_drop" not in text


def test_key_filters_reach_both_scans(stored_report):
    text = plan(stored_report.where("id = 7"))
    assert "EqualTo(id,7)" in text and "EqualTo(alert_id,7)" in text
