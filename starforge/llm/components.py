"""Connected components of a link table, by large-star and small-star steps.

Both steps join every link with the smallest neighbour of one of its ends and keep the
components as they are; repeated, they turn each component into a star around its
smallest node.  All steps are joins and grouped minima (no task sees all links of a node
at once); each round is written to the shared scratch folder, which cuts the lineage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import staged


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable from every node that has a link."""
    edges = staged(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where("u > v").distinct(), "links")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .union(edges.select("v", "v").distinct())
        before = now
        # large star: every larger neighbour of a node is linked to its smallest neighbour
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours of a node are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(least).distinct(), "links")
