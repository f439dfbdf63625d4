"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fisclake.llm.shared import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node with a link; ``links`` has two long columns.

    Alternates two steps until nothing changes: every node passes the smallest of its neighbours and itself on to its larger
    neighbours (large star), then to its smaller ones (small star). Each round is written to the shared folder. Only minima are
    gathered per node, before the shuffle; the join that hands them out is one whose hot keys adaptive execution splits.
    Rounds grow with the logarithm of the nodes.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).filter("high <> low").distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(edges.select(F.col("low").alias("u"), F.col("high").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))
        large = large.filter("high <> low").distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high").select(F.col("low").alias("high"), F.col("m").alias("low"))
        small = small.filter("high <> low").union(least.select("high", F.col("m").alias("low"))).distinct()
        edges = stored(small, "links")
        # The links are stars, each around its smallest node, once a round brings back the same links.
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.col("high").cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.sum(F.col("low").cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.bit_xor(F.xxhash64("high", "low")), F.lit(0))).first()
        if now == before:
            break
        before = now
    return edges.groupBy("high").agg(F.min("low").alias("root")).select(F.col("high").alias("node"), "root").union(
        edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
