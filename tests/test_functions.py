from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from floodmark.functions import amounts, names, times


@pytest.mark.parametrize(
    "series, step, total",
    [
        (None, 60, None),
        ([], 60, None),
        ([None, None], 60, None),
        ([1.0, None, 2.5], 60, 210.0),
        ([1.0], None, None),
        ([0.0], 60, 0.0),
    ],
)
def test_series_total(spark, series, step, total):
    row = spark.createDataFrame([(series, step)], "series array<double>, step int")
    assert row.select(amounts.series_total(F.col("series"), F.col("step"))).first()[0] == total


@pytest.mark.parametrize("bits, whole", [(20.0, 2), (28.0, 4), (24.1, 3), (None, None), (-20.0, -2)])
def test_bits_to_bytes_rounds_halves_to_even(spark, bits, whole):
    row = spark.createDataFrame([(bits,)], "bits double")
    assert row.select(amounts.bits_to_bytes(F.col("bits"))).first()[0] == whole


@pytest.mark.parametrize(
    "moment, second",
    [
        (datetime(2024, 1, 1, 0, 0, 0, 499_999), datetime(2024, 1, 1)),
        (datetime(2024, 1, 1, 0, 0, 0, 500_000), datetime(2024, 1, 1, 0, 0, 1)),
        (datetime(2024, 12, 31, 23, 59, 59, 700_000), datetime(2025, 1, 1)),
        # Before 2000 halves go down, as they count from that year.
        (datetime(1999, 12, 31, 23, 59, 58, 500_000), datetime(1999, 12, 31, 23, 59, 58)),
        (datetime(1999, 12, 31, 23, 59, 58, 500_001), datetime(1999, 12, 31, 23, 59, 59)),
    ],
)
def test_round_to_second(spark, moment, second):
    row = spark.range(1).select(times.round_to_second(times.ntz(moment)))
    assert row.first()[0] == second


def test_utc_instant_ignores_session_zone(spark):
    # One hour of this night happens twice in New York.
    moment = datetime(2024, 11, 3, 1, 30)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        micros = spark.range(1).select(F.unix_micros(times.utc_instant(times.ntz(moment)))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == (moment - datetime(1970, 1, 1)) / timedelta(microseconds=1)


def test_offsets_are_dropped_not_applied(spark):
    row = spark.range(1).select(times.parse_ntz(F.lit("2024-05-01T10:00:00+05:00")))
    assert row.first()[0] == datetime(2024, 5, 1, 10)


def test_request_bounds(spark):
    rows = spark.createDataFrame(
        [("2024-05-01T10:00:00+00:00", None), ("2024-05-01T10:00:00", "2024-05-01T11:00:00+00:00")],
        "start string, stop string",
    )
    now = datetime(2024, 5, 2, 3, 4, 5, 678)
    bounds = times.request_bounds(F.col("start"), F.col("stop"), now)
    assert [tuple(r) for r in rows.select(*bounds).collect()] == [
        ("2024-05-01T10:00:00Z", "2024-05-02T03:04:05Z"),
        ("2024-05-01T10:00:00Z", "2024-05-01T11:00:00Z"),
    ]


def test_methods_in_ids_are_not_exclusive(spark):
    ids = ["tms-1", "flowspec-tms-1", "blackhole-flowspec", "other"]
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    assert [r[0] for r in rows.select(names.rates_method(F.col("id"))).collect()] == [
        "tms", "flowspec", "blackhole", None,
    ]


@pytest.mark.parametrize(
    "mark, never", [(None, True), (datetime(1970, 1, 1, 2), True), (datetime(2024, 1, 1), False)]
)
def test_never_loaded(spark, mark, never):
    row = spark.createDataFrame([(mark,)], "mark timestamp_ntz")
    assert row.select(times.never_loaded(F.col("mark"))).first()[0] is never
