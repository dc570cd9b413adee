"""Data-quality checks.  Each returns its findings as a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark import schemas, seeds
from floodmark.schemas import TableSpec


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def compare_counts(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Counts beside the expected ones, and whether they agree; a missing table does not."""
    agree = F.coalesce(F.col("row_count") == F.col("expected_count"), F.lit(False))
    return expected.join(counts, "table_name", "left").withColumn("ok", agree)


def require(findings: DataFrame) -> None:
    """Fail where a comparison has a row that is not ok."""
    wrong = findings.where(~F.col("ok"))
    if not wrong.isEmpty():
        raise ValueError(f"check failed: {wrong.first().asDict()}")


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return (
        rows.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    )


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Number of nulls in each column that must not hold any."""
    return rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "null_count"
    )


def wrong_values(rows: DataFrame, expected: DataFrame, key: str, value: str) -> DataFrame:
    """Expected values beside the ones found, and whether they agree."""
    found = rows.select(key, F.col(value).alias("found"))
    wanted = expected.select(key, F.col(value).alias("expected"))
    agree = F.coalesce(F.col("found") == F.col("expected"), F.lit(False))
    return wanted.join(found, key, "left").withColumn("ok", agree)


# What a fresh installation must hold.
KNOWN_OBJECT = (10, "Dark IP")


def fresh_findings(store) -> DataFrame:
    """Rows of all tables beside those of a fresh store, and whether the known object has its name."""
    sizes = [(t.name, len(seeds.SEED_ROWS.get(t.name, []))) for t in schemas.TABLES]
    expected = seeds.literal_rows(store.spark, sizes, "table_name string, expected_count bigint")
    counts = table_counts({t.name: store.table(t) for t in schemas.TABLES})
    known = seeds.literal_rows(
        store.spark, [KNOWN_OBJECT], "id int, managed_object_name string"
    )
    named = wrong_values(store.managed_object.read(), known, "id", "managed_object_name")
    return compare_counts(counts, expected).unionByName(
        named.select(
            F.col("expected").alias("table_name"),
            F.lit(1).cast("bigint").alias("expected_count"),
            F.col("ok").cast("bigint").alias("row_count"),
            "ok",
        )
    )


def verify_fresh(store) -> bool:
    """Whether a new store holds exactly its seeds.  A failing lookup counts as no."""
    return fresh_findings(store).where(~F.col("ok")).isEmpty()


def table_faults(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Violations of a table's constraints: repeated keys and missing required values."""
    repeated = duplicate_keys(rows, spec.key).agg(F.count(F.lit(1)).alias("faults"))
    missing = null_counts(rows, spec.required).agg(F.sum("null_count").alias("faults"))
    return repeated.select(F.lit("repeated key").alias("fault"), "faults").unionByName(
        missing.select(F.lit("missing value").alias("fault"), "faults")
    )


def faults_of_all(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of the constraints of every table, by name."""
    specs = {spec.name: spec for spec in schemas.TABLES}
    found = [
        table_faults(rows, specs[name]).select(F.lit(name).alias("table_name"), "fault", "faults")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)
