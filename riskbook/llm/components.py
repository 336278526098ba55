"""Connected components of a distributed graph by alternating star contraction.

Every round is a few joins and sums on the edges; nothing is gathered in one place. Large star ties each
node's larger neighbours to its least neighbour, small star does so with the smaller ones; the edges
end as one star per component, centred on its least node, after about log(n) rounds; one round does where
they were stars before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    tied = both.filter("v > u").join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
    result = stored(tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
    discard(least)
    return result


def _small_star(edges: DataFrame) -> DataFrame:
    # Each edge points from its larger end u to its smaller end v.
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    tied = down.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
    moved = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    kept = least.select("u", F.col("m").alias("v"))
    result = stored(moved.union(kept).distinct(), "small")
    discard(least)
    return result


def _is_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is nobody's smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.agg(F.coalesce(F.max(F.col("up") + F.when(F.col("up") > 0, F.col("down")).otherwise(0)), F.lit(0))).first()[0] <= 1


def components(edges: DataFrame) -> DataFrame:
    """From edges (u, v) of whole numbers: (node, root), the least node of its component, for every node
    that is not its own root. Edges to NULL or to the node itself are no edges."""
    now = stored(edges.select("u", "v").filter("u <> v"), "edges")
    while True:
        large = _large_star(now)
        small = _small_star(large)
        discard(now, large)
        now = small
        if _is_stars(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
