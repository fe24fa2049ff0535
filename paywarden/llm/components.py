"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paywarden.llm.tables import stage


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of ``links`` (a, b: long); label is the least node reached.

    Alternates two steps until nothing changes: every node tells its larger
    neighbours of its least one, then every node tells its smaller neighbours.
    Each step is one aggregation by node with map-side minima, and one join
    whose skewed keys Spark may split; rounds grow with the logarithm of a
    component's size.
    """
    links = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    n, total = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while n:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").where("b <> m").toDF("a", "b")
        links = stage(small.union(least.toDF("a", "b")).distinct(), "links")
        count, now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (count, now) == (n, total):
            break
        n, total = count, now
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("label"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
