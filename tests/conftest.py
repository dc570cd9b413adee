from __future__ import annotations

import json
from datetime import datetime

import pytest

from floodmark.session import build_session
from floodmark.sources.landing import Landing
from floodmark.store import Store


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, str(tmp_path / "landing"))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), range_width=10)


NOW = datetime(2024, 5, 2, 12)
BATCH = "2024-05-02T00:00:00"


def put(landing, kind, *documents, name="part", date=None):
    """Land documents (dicts, or text for broken ones) as one file."""
    import pathlib

    folder = pathlib.Path(landing.folder(kind))
    if date:
        folder = folder / f"batch_date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n")


def alert(id_, mitigations=None, owner="1", **changed):
    """An alert document; keyword arguments replace or, with None, remove fields."""
    sub = {
        "countries": ["DE"],
        "direction": "Incoming",
        "fast_detected": True,
        "host_address": "10.0.0.1",
        "impact_boundary": "edge",
        "impact_bps": 100.0,
        "impact_pps": 10.0,
        "ip_version": 4,
        "misuse_types": ["UDP"],
        "protocols": ["udp"],
        "severity_percent": 110.5,
        "severity_threshold": 5.0,
        "severity_unit": "bps",
    }
    attributes = {
        "alert_class": "dos",
        "alert_type": "dos_host_detection",
        "classification": "Possible Attack",
        "importance": 2,
        "ongoing": False,
        "start_time": "2024-05-01T10:00:00+00:00",
        "stop_time": "2024-05-01T11:00:00+00:00",
    }
    relationships = {}
    if owner is not None:
        relationships["managed_object"] = {"data": {"id": owner}}
    if mitigations is not None:
        relationships["mitigation"] = {"data": [{"id": m} for m in mitigations]}
    for part in (sub, attributes):
        for field in [f for f in part if f in changed]:
            value = changed.pop(field)
            if value is None:
                del part[field]
            else:
                part[field] = value
    relationships |= changed.pop("relationships", {})
    assert not changed, changed
    return {
        "id": str(id_),
        "attributes": {**attributes, "subobject": sub},
        "relationships": relationships,
    }


def page(*alerts, number=1, total=1, batch=BATCH):
    return {
        "batch_at": batch,
        "page": number,
        "data": list(alerts),
        "meta": {"pagination": {"totalPages": total}},
    }


def detail(id_, alert_id, subtype="tms", batch=BATCH, number=1, **attributes):
    values = {
        "name": f"name of {id_}",
        "subtype": subtype,
        "user": "ann",
        "start": "2024-05-01T10:05:00+00:00",
        "stop": "2024-05-01T10:55:00+00:00",
        "is_automitigation": True,
        "ongoing": False,
    }
    return {
        "batch_at": batch,
        "page": number,
        "mitigation_id": id_,
        "data": {
            "id": id_,
            "attributes": {**values, **attributes},
            "relationships": {"alert": {"data": {"id": str(alert_id)}}},
        },
    }


def device_rates(id_, alert_id, bps=None, pps=None, batch=BATCH, step=60):
    def stat(series):
        return {"average": 1.0, "max": 2.0, **({} if series is None else {"timeseries": series})}

    return {
        "batch_at": batch,
        "alert_id": str(alert_id),
        "mitigation_id": id_,
        "data": {
            "attributes": {
                "timeseries_start": "2024-05-01T10:05:00+00:00",
                "step": step,
                "total": {"drop": {"bps": stat(bps), "pps": stat(pps)}},
            }
        },
    }


def unit_value(unit, series, top=9.0, step=60):
    return {
        unit: {
            "step": step,
            "timeseries_start": "2024-05-01T10:05:00+00:00",
            "avg_value": 3.0,
            "max_value": top,
            "timeseries": series,
        }
    }


def flowspec_rates(alert_id, unit, entries, batch=BATCH):
    """``entries`` are pairs of mitigation id and value."""
    return {
        "batch_at": batch,
        "alert_id": str(alert_id),
        "unit": unit,
        "data": [
            {
                "relationships": {"mitigation": {"data": {"id": id_}}},
                "attributes": {"view": {"flowspec": {"unit": value}}},
            }
            for id_, value in entries
        ],
    }


def blackhole_rates(alert_id, unit, entries, batch=BATCH):
    """``entries`` are pairs of entry id and value."""
    return {
        "batch_at": batch,
        "alert_id": str(alert_id),
        "unit": unit,
        "data": [
            {"id": id_, "attributes": {"view": {"blackhole": {"unit": value}}}}
            for id_, value in entries
        ],
    }


def by_id(frame, key="id"):
    return {row[key]: row for row in frame.collect()}
