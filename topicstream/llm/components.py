"""Connected components by alternating large-star and small-star rounds over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.session import staged_table


def _star(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step; links point from the larger node ``a`` to the smaller ``b``."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.filter(F.col("a") > F.col("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    to_least = large.join(least, "a").filter(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_least.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of any ordered type to one row (node, component) per linked node; component is its smallest node.

    Every round is a written table, so a lost executor costs one round at most. The rounds end when the links, then stars
    around the smallest nodes, no longer change; a chain of n nodes takes about log n rounds. Links from a node to itself and null
    ends are ignored; an empty table gives an empty table.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = staged_table(links.distinct(), "links")
    before = _state(links)
    while before[0]:
        links = staged_table(_star(links), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    member = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return member.union(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
