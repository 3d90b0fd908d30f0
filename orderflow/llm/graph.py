"""Connected components of links, as joins and aggregations of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, from links (a, b) of longs.

    Alternates two steps until all groups are stars: every node hands its larger neighbours to its
    smallest one, then its smaller ones. A group becomes a star around its smallest node in a
    number of rounds that grows with the logarithm of its size. Each step is a minimum by node,
    combined before the shuffle, and a join with it; a node with many links is split by the join.
    The minima that begin a round tell whether it is needed, and are the result if not; they are
    stored.
    """
    edges = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    below = F.when(F.col("b") < F.col("a"), F.col("b"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(
            both.groupBy("a").agg(
                F.least(F.min("b"), F.col("a")).alias("low"), F.min(below).alias("first"), F.max(below).alias("last"), F.max("b").alias("high")
            ),
            "lowest",
        )
        # In a star, a node with a smaller neighbour has no other one.
        if low.filter("first <> last OR (first IS NOT NULL AND high > a)").isEmpty():
            return low.select(F.col("a").alias("node"), F.col("low").alias("root"))
        large = both.join(low.select("a", "low"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = written(large.distinct(), "links")
        low = written(large.groupBy("a").agg(F.min("b").alias("low")), "lowest")
        small = (
            large.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(low.select("a", F.col("low").alias("b")))
        )
        edges = written(small.distinct(), "links")


def joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root): ``classes`` (node, root) after links (a, b) between them.

    A link names the roots of two classes, or nodes that are in none; only those are searched.
    """
    tops = components(links)
    if tops.isEmpty():
        return classes
    moved = classes.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    new = tops.join(classes.select("node"), "node", "left_anti")
    return written(moved.select("node", F.coalesce("top", "root").alias("root")).unionByName(new), "joined-classes")
