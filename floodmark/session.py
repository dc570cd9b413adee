"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on.  AQE merges small shuffle partitions and splits
# skewed ones; how many there are to begin with depends on the data, see
# ``sized_for``.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}

# For writes: the files shuffled for one go when it ends, as nothing reads them again.
SHUFFLES_LET_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# A reducer's share of a shuffle, and the least number of reducers.
SHUFFLE_PARTITION_BYTES = 512 * 2**20
FEWEST_PARTITIONS = 200


def sized_for(input_bytes: int) -> dict[str, str]:
    """Settings for a job that may shuffle all of its input.

    The number of reducers is fixed before AQE can act, and AQE can only lower
    it, so it is set for the worst case, half a GB each.  Files are
    read and written in pieces that fit it.
    """
    partitions = max(-(-input_bytes // SHUFFLE_PARTITION_BYTES), FEWEST_PARTITIONS)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def build_session(
    app: str = "floodmark", input_bytes: int | None = None, **settings: str
) -> SparkSession:
    """A session with the settings above, sized for the input where it is given."""
    sized = {} if input_bytes is None else sized_for(input_bytes)
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **sized, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def partitions_for(spark: SparkSession, total: int, each: int) -> tuple[str, str]:
    """The number of reducers as a setting: the session's, or more where one's share is over ``each``."""
    name = "spark.sql.shuffle.partitions"
    return name, str(max(int(spark.conf.get(name)), -(-total // each)))


def input_bytes(*inputs: DataFrame) -> int:
    """What the planner knows of the size of the files read."""
    total = 0
    for frame in inputs:
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        for leaf in (leaves.apply(n) for n in range(leaves.size())):
            # Other leaves hold no files, and the planner knows nothing of their size.
            if leaf.nodeName().startswith("LogicalRelation"):
                total += int(str(leaf.stats().sizeInBytes()))
    return total


def size_for_inputs(spark: SparkSession, *inputs: DataFrame) -> None:
    """Size the session for inputs by what the planner knows of their files."""
    for name, value in sized_for(input_bytes(*inputs)).items():
        spark.conf.set(name, value)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs run meanwhile; the session's own are put back after them."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A plain local run that names none gets a temporary folder; a cluster must
    name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="floodmark-")
