"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import lookup, written


def _star(edges: DataFrame) -> DataFrame:
    """Each pair (u, v) with the least number among u and all its neighbours."""
    rows = edges.count()
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("size"))
    return lookup(edges, least.withColumn("m", F.least("u", "m")), "u", "size", max(1, rows))


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of the links (u, v), the root being the least node that it
    is linked to by any path; roots are listed as well.

    A round ties every larger neighbour of a node to the least one (large star), then every
    smaller neighbour and the node itself (small star), until the links stay the same. All
    nodes of a component then point at its least node. No links give no rows.
    """
    links = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "links")
    before = None
    while True:
        both = written(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links-both")
        large = _star(both).filter("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links-large")
        small = _star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        links = written(small.filter("u > v").distinct(), "links-small")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return links.select("u", F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
