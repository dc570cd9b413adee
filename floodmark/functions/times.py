"""Timestamps without zone, and their few meetings with real instants."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# How far back every load window reaches beyond its start.
LATE_ARRIVAL = timedelta(hours=2)


def ntz(moment: datetime) -> Column:
    """A constant timestamp without zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_ntz(text: Column) -> Column:
    """ISO text to timestamp; a zone suffix is dropped, never applied."""
    return text.cast("timestamp_ntz")


def total_seconds(interval: Column) -> Column:
    """Length of a day-time interval in seconds, microseconds kept."""
    return interval.cast("interval second").cast("decimal(20,6)")


def utc_instant(moment: Column) -> Column:
    """Read a timestamp without zone as UTC, whatever the session zone is."""
    since_epoch = total_seconds(moment - F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.timestamp_micros((since_epoch * 1_000_000).cast("bigint"))


def round_to_second(moment: Column) -> Column:
    """Nearest whole second; halves move away from the start of the year 2000."""
    fraction = F.extract(F.lit("SECOND"), moment) % 1
    half_up = moment >= F.lit("2000-01-01").cast("timestamp_ntz")
    goes_up = (fraction > 0.5) | ((fraction == 0.5) & half_up)
    return moment + F.make_dt_interval(secs=F.when(goes_up, 1 - fraction).otherwise(-fraction))


def lookback(start: Column) -> Column:
    """Start of a load window, moved back for alerts that arrive late."""
    return start - F.lit(LATE_ARRIVAL)


def request_bounds(start: Column, stop: Column, now: datetime) -> tuple[Column, Column]:
    """Start and end of the window rates are asked for, as zone-marked ISO text.

    An alert without a stop time is followed up to ``now``, in whole seconds.
    """
    open_end = F.lit(now.replace(microsecond=0).isoformat())

    def zulu(text: Column) -> Column:
        return F.concat(F.substring_index(text, "+", 1), F.lit("Z"))

    return zulu(start), zulu(F.coalesce(stop, open_end))


def never_loaded(mark: Column) -> Column:
    """A mark that is missing, or still the seed of the year 1970."""
    return mark.isNull() | (F.year(mark) == 1970)
