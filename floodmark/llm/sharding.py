"""A uniform random shuffle into shards of equal row counts.

The method is that of distributed permutation: rows lie in source parts; how
many of each part go to each shard is one exact draw from the multivariate
hypergeometric law, given the part and shard sizes; every part permutes its rows
and deals them out by those counts; the shards then permute what they received.
All permutations of the table are equally likely, and counts differ by one at
most between shards.

Only the matrix of counts is drawn on the driver, at most 4,096 parts by the
number of shards.  Both permutations are sorts by hashed keys with a seed, so a
task that is run again makes the same decisions.  Each shard's rows fall at random
into up to 4,096 ranges of slots, so no task orders a whole shard.

Row counts are the law that holds, so groups of equal texts may be parted.  A null
or empty text has one byte of size and the checksum 0.  Rows that are equal in id
and text may change places with each other and nothing else; null ids are as good
as others.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodmark.llm.common import read

SHARDS = 8
SEED = 20_240_501
# Mean rows of a source part or a range of slots, and the most of them.
PART_ROWS = 50_000
MOST_PARTS = 4_096


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Counts per part and shard: exact row sums, column sums at most one apart."""
    total = sum(sizes)
    room = np.full(shards, total // shards, np.int64)
    room[: total % shards] += 1
    random = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        # The library draws one marginal after the other, so large sizes are fine.
        drawn = random.multivariate_hypergeometric(room, size, method="marginals")
        rows.append(drawn)
        room = room - drawn
    return np.array(rows, np.int64).reshape(len(sizes), shards)


def _parts(rows: int) -> int:
    return int(min(max(1, -(-rows // PART_ROWS)), MOST_PARTS))


def shard_uniformly(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_col: str = "shard",
    slot_col: str = "slot",
) -> DataFrame:
    """The rows with the shard and slot of each; a column of such a name is replaced."""
    spark = docs.sparkSession
    plain = docs.drop(shard_col, slot_col)
    row = F.struct(*[F.col(c) for c in plain.columns]).alias("row")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = plain.select(row, F.xxhash64(F.lit(seed), F.col(id_col), text).alias("name"))
    rows = named.count()
    parts = _parts(rows)
    # High bits choose the part, other hashes order the rows within it and in the shard.
    named = named.withColumn("part", F.pmod(F.xxhash64("name", F.lit(1)), F.lit(parts)))
    counts = dict(named.groupBy("part").count().collect())
    matrix = communication_matrix([counts.get(p, 0) for p in range(parts)], shards, seed)
    below = np.cumsum(matrix, axis=1)
    plan = spark.createDataFrame(
        [(p, below[p].tolist()) for p in range(parts)], "part long, below array<long>"
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy("first_key", "name"))
    dealt = (
        named.withColumn("first_key", F.xxhash64("name", F.lit(2)))
        .withColumn("place", place)
        .join(plan, "part")
        .select(
            "row",
            "name",
            F.size(F.filter("below", lambda b: b < F.col("place"))).alias("shard"),
            F.xxhash64("name", F.lit(3)).alias("second_key"),
        )
    )
    # Slots go range by range; the sizes of the ranges give each its first slot.
    ranges = _parts(-(-rows // shards))
    dealt = dealt.withColumn("range", F.pmod(F.xxhash64("name", F.lit(4)), F.lit(ranges)))
    held = dealt.groupBy("shard", "range").count()
    first = F.sum("count").over(
        Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    begins = held.select("shard", "range", F.coalesce(first, F.lit(0)).alias("begin"))
    inside = F.row_number().over(
        Window.partitionBy("shard", "range").orderBy("second_key", "name")
    )
    return (
        dealt.withColumn("inside", inside)
        .join(begins, ["shard", "range"])
        .select(
            "row.*",
            F.col("shard").alias(shard_col),
            (F.col("begin") + F.col("inside") - 1).alias(slot_col),
        )
    )


def op7_uniform_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7, row counts at most one apart."""
    text = F.coalesce("text", F.lit(""))
    digests = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return shard_uniformly(digests, text_col="text_crc32").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
