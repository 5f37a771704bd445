"""Connected components of a table of links, by alternating stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import stage


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _least(links: DataFrame) -> DataFrame:
    """The least neighbour of each node, written down: a join of two plain tables can be
    split where one node has many links."""
    return stage(links.groupBy("a").agg(F.min("b").alias("least")), "least")


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (a, root): the smallest node of the component of every node that
    has a larger one above it; roots and nodes without links are not listed.

    Each round works on distinct links and only minima travel; the rounds grow with
    the logarithm of the longest chain.
    """
    links = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = stage(links.distinct(), "links")
    before = _state(links)
    while before[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both)
        large = (
            both.join(least, "a")
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
            .distinct()
        )
        large = stage(large, "large-star")
        least = _least(large)
        small = large.join(least, "a").filter(F.col("b") != F.col("least"))
        links = stage(
            small.select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(least.select("a", F.col("least").alias("b")))
            .distinct(),
            "links",
        )
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select("a", F.col("b").alias("root"))
