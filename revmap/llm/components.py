"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmap.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of these; a > b holds on both ends."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    joined = edges.join(least, "a")
    own = joined.select("a", F.col("m").alias("b"))
    others = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.union(others).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one link to a smaller node at most, and then none to a larger."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, component): the least node that can be reached.

    Only nodes with a link to a smaller node are returned; any other node is its
    own component. A node's neighbours are never gathered: groups are reduced by
    ``min``, stored, and joined back in a join that Spark may split on skew. Each round
    is written to shared storage, and the number of rounds grows with the
    logarithm of the longest chain.
    """
    edges = stored(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _are_stars(edges):
        edges = stored(_small_star(stored(_large_star(edges), "large-stars")), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
