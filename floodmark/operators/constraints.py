"""Constraints of a table, checked by the write that fills it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from floodmark.schemas import TableSpec
from floodmark.session import SHUFFLES_LET_GO, settings


class ConstraintError(ValueError):
    """Rows that a table must not hold."""


def write_checked(
    rows: DataFrame,
    spec: TableSpec,
    write: Callable[[DataFrame], None],
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Write rows, and fail where a required column, or one derived from the rows, has nulls.

    They are counted while the rows are written, so no row is read twice.  What was
    written stays where it is; the caller puts it in use only after this.
    """
    seen = Observation()
    required = {c: (derived or {}).get(c, F.col(c)) for c in spec.required}
    with settings(rows.sparkSession, SHUFFLES_LET_GO):
        write(rows.observe(seen, *[F.count_if(value.isNull()).alias(c) for c, value in required.items()]))
    missing = {column: number for column, number in seen.get.items() if number}
    if missing:
        faults = ", ".join(f"null {column} in {number} rows" for column, number in missing.items())
        raise ConstraintError(f"{spec.name}: {faults}")
