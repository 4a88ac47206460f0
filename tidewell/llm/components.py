"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import durable


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its neighbourhood."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return near.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v"))


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` links (longs) -> ``(u, root)`` for every linked node but the roots themselves.

    The root is the smallest node of a component.  Every round is written to the shared folder; rounds end
    when the edges no longer change, which takes about the logarithm of the longest path.  A node with very
    many neighbours is a skewed join key, which adaptive execution splits.
    """
    stars = durable(
        edges.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    mark = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            return stars.select("u", F.col("v").alias("root"))
        mark = tuple(state)
        stars = durable(_small_star(_large_star(stars).distinct()).distinct(), "links")
