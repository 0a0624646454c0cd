"""Connected components by alternating stars, on edges of any two comparable keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.session import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u goes to the least of u and its neighbours."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours go to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.union(own).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node that has an edge.

    `edges` has u and v. Each round is written to the shared folder, which cuts the lineage, and the
    rounds end when nothing changes; their number grows with the logarithm of the longest path.
    """
    now = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
        if not seen[0]:
            break
        now = written(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
