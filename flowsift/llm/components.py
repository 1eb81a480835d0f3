"""Connected components of links that stay on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node) of every node of ``a, b`` links.

    Alternates large-star and small-star steps: each node points its larger, then its smaller
    neighbours to the smallest one it sees. Steps are written to the shared folder; the number of
    steps grows with the logarithm of the longest chain, and no step has more rows than links.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m")).distinct()
        edges = stage(small, "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).head())
        if now == before:
            break
        before = now
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
