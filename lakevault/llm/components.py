"""Connected components of a graph given as a table of links."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import stage, unstage


def components(links: DataFrame) -> DataFrame:
    """For each node of the links (long columns a, b) the smallest node it is connected with: node, component.

    Large-star and small-star steps take turns: every node hands its smallest neighbour to its larger, then to
    its smaller neighbours, so paths halve and each component ends as a star around its smallest node. Minima are
    added up before the shuffle and joined back, which lets Spark split a node with very many links. Each turn
    is a written table. Links with a null end or from a node to itself count for nothing.
    """
    edges = stage(links.select("a", "b").where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        # Large star: every larger neighbour learns the smallest node around.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # Small star: links now lead from larger to smaller nodes; smaller neighbours learn the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        last, edges = edges, stage(small.select("e.a", "e.b").where("a != b").distinct(), "links")
        unstage(last)
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = found
