"""Connected components of a graph given by its edges, for the near-duplicate operators.

Alternating large-star and small-star rounds: each node's smallest neighbour is found by a partial
aggregation, no neighbour list is ever gathered, and every round cuts its lineage by a checkpoint. The
number of edges never grows, and a path of n nodes needs about log(n) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that ``edges`` (a long, b long) names; ``root`` is the smallest node."""
    a, b = F.col("a"), F.col("b")
    stars = cut(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    state = None
    while True:
        # large-star: a node's larger neighbours move to its smallest neighbour
        both = stars.union(stars.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min(F.least(a, b)).alias("least"))
        moved = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("least").alias("b"))
        moved = moved.where(a != b).distinct()
        # small-star: a node and its smaller neighbours move to the smallest of them
        least = moved.groupBy("a").agg(F.min("b").alias("least"))
        joined = moved.join(least, "a")
        stars = cut(joined.where(b != F.col("least")).select(b.alias("a"), F.col("least").alias("b"))
                    .union(least.select("a", F.col("least").alias("b"))).distinct())
        # distinct edges: an unchanged count and sum of hashes mean an unchanged graph
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return stars.select(a.alias("node"), b.alias("root")).union(
        stars.select(b.alias("node"), b.alias("root"))).distinct()
