"""Connected components of a graph given as a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.plans.storage import materialise


def components(edges: DataFrame) -> DataFrame:
    """(id, component): of every id in ``edges`` (a, b), the smallest id that it is connected with.

    Each round hangs every neighbour of a vertex on the least one around it: first the larger neighbours, then
    the smaller. Least neighbours are partial minima and are joined back, so a vertex with very many neighbours
    is spread over tasks. The number of rounds grows with the logarithm of the longest chain.
    """
    pairs = materialise(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        after = materialise(small.where("u <> v").distinct())
        # Stars alone are left when nothing moves any more.
        if after.count() == pairs.count() and after.exceptAll(pairs).isEmpty():
            break
        pairs = after
    stars = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
