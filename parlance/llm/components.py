"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import Stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of the links (a, b); the component is its smallest id.

    A round hangs the larger neighbours of every node, then the smaller ones, on the smallest
    neighbour; the rounds end when the links no longer change, which takes about the logarithm of the
    longest path. Each round is stored, and only counts reach the driver.
    """
    edges = Stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
        both = edges.df.select(F.inline(ends))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("b"), F.least("u", "m").alias("m"))
        # Every a is larger than its b, so these are the larger neighbours of all nodes.
        large = edges.df.join(least, "b").select("a", F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = Stored(small.union(smallest).distinct(), "links")
        edges.drop()
        edges = after
        state = tuple(edges.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        before = state
    hung = edges.df.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return hung.union(hung.select(F.col("component").alias("id"), "component").distinct())


def extended(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components (id, component) of further links, from those found before and the new links alone.

    ``found`` is a stored result of ``components`` or of this function. Only components that a new link
    joins, and ids not met before, are nodes of the rounds.
    """
    if links.isEmpty():
        return found
    one, two = (found.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}")) for end in "ab")
    between = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    joined = Stored(components(between), "components-joined").df
    moved = joined.select(F.col("id").alias("component"), F.col("component").alias("moved"))
    held = found.join(moved, "component", "left").select("id", F.coalesce("moved", "component").alias("component"))
    return Stored(held.unionByName(joined.join(found, "id", "left_anti")), "components").df
