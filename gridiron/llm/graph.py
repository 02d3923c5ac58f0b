"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridiron.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, label for all ids in `links` (a, b): the smallest id reachable.

    Alternates large-star and small-star steps, which only take minima over neighbours,
    until nothing changes.  Links and minima are written to the shared folder: then a
    join shuffles both sides for itself, and Spark can split the rows of a node that
    very many are linked to.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        edges = written(_small_star(written(_large_star(edges), "links")), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(own)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where("a > b")
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    hung = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
