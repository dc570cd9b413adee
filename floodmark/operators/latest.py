"""One row per key: the last (or first) to arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_arrival_rank"


def latest_per_key(rows: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest arrival order for each key.

    Spark limits each key to its top row before the shuffle (window group
    limit), so a key repeated very often sends one row per map task.
    """
    return _ranked_first(rows, keys, [F.col(c).desc_nulls_last() for c in arrival])


def first_per_key(rows: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Keep the row with the smallest arrival order for each key."""
    return _ranked_first(rows, keys, [F.col(c).asc_nulls_first() for c in arrival])


def _ranked_first(rows, keys, order):
    by_arrival = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn(_RANK, F.row_number().over(by_arrival))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )
