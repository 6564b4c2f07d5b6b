"""Connected components of a link table, in rounds that each leave a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node it is connected with.

    Alternating stars: first every larger neighbour of a node is linked to the
    least of its neighbourhood, then every node and its smaller neighbours to the
    least of those. Links only ever move towards the least node, and the number of
    rounds follows the logarithm of the longest path. Minima are summed up before
    they are shuffled, so a hub of any degree is no burden; joins on a hub are
    plain ones that Spark may split. Nothing but a count and a checksum reaches
    the driver. Loops and repeated links are allowed.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "links",
    )
    before = None
    while before != (now := checksum(edges)):
        before = now
        edges = materialise(small_star(large_star(edges)), "links")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()
