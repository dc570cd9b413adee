"""Totals of dropped traffic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_total(series: Column, step: Column) -> Column:
    """Sum of a rate series times its step in seconds.

    Missing points are skipped.  A series without any point has no total.
    """
    nothing = F.lit(None).cast("double")
    total = F.aggregate(series, nothing, lambda so_far, x: F.coalesce(so_far + x, so_far, x))
    return total * step


def bits_to_bytes(bits: Column) -> Column:
    """Whole bytes, nearest, halves to the even neighbour."""
    return F.rint(bits / 8).cast("bigint")
