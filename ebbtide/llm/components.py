"""Connected components by passing the smallest label along links and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of links (a, b); nodes are longs.

    Alternates two steps on the links until nothing changes: all larger neighbours of a node are tied to the
    smallest node it knows, then all smaller ones. Every step keeps the components and ends in
    stars. A node with a great many links is split by Spark like any skewed join key.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stored(pairs, "links")
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("p"))
        small = stored(small.select(F.col("p.b").alias("a"), F.col("p.m").alias("b")).where("a <> b").distinct(), "links")
        sums = [x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for x in (pairs, small)]
        pairs = small
        if sums[0] == sums[1]:
            break
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
