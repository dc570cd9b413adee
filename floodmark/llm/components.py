"""Connected components of a table of links, by repeated joins.

Large-star and small-star steps: every node is linked to the least of its
neighbourhood instead of to the neighbours themselves.  Links become stars around
the least node of each component after a number of rounds that grows with the
logarithm of its size.  Every round is written, so its lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    away = F.col("b") > F.col("a") if large else F.col("b") < F.col("a")
    moved = both.filter(away).join(least, "a").select(F.col("least").alias("a"), "b")
    if not large:
        moved = moved.union(least.filter("least < a").select("least", "a"))
    return (
        moved.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a"))
        .filter("a < b")
        .select("a", "b")
        .distinct()
    )


def _are_stars(links: DataFrame) -> bool:
    """Whether every node is a centre or has one link, to a smaller centre."""
    twice = links.groupBy("b").count().filter("count > 1").select("b")
    middle = links.select("b").join(links.select(F.col("a").alias("b")), "b", "left_semi")
    return twice.union(middle).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node and component (its least node) of every node with a link.

    ``links`` has the columns a and b, both long; links to oneself and repeated
    ones do no harm.
    """
    links = written(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b")
        .distinct(),
        "links",
    )
    while not _are_stars(links):
        links = written(_star(_star(links, large=True), large=False), "links")
    centre = links.groupBy("a").agg(F.col("a").alias("component"))
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        centre.select(F.col("a").alias("node"), "component")
    )
