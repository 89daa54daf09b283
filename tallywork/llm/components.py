"""Connected components of a link table by alternating star contraction, in Spark joins.

Nothing but a count and a checksum of each round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .store import Keep


def _checksum(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(links: DataFrame, keep: Keep, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id in a link; the component is its smallest id.

    Each round hangs every node below the smallest node next to it, first from the larger side, then from
    the smaller one. The number of rounds grows with the logarithm of the longest chain. ``keep`` writes the
    table of a round and reads it back.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = keep(edges, "links")
    seen = _checksum(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large, "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
