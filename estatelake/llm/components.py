"""Connected components of a distributed edge list by alternating large and small stars.

Every step is a join or a group minimum over the edges, so a node with very many
neighbours is aggregated on the map side and its join partition can be split;
no component, edge list or neighbour list is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.shared import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``, longs); root is the smallest node reachable.

    Loops and repeated edges are allowed; nodes without an edge are not listed.
    """
    stars = (
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    stars, before = cut_lineage(stars), None
    while True:
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        both = stars.select(F.col("u").alias("n"), F.col("v").alias("o")).union(stars.select("v", "u"))
        least = both.groupBy("n").agg(F.min("o").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.where("o > n").join(least, "n").select(F.col("o").alias("u"), F.col("m").alias("v")).distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(nearest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(moved.union(nearest).distinct())
    roots = stars.select("v").distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
