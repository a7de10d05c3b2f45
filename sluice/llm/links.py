"""Connected components of pairs, by star contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sluice.session import stage


def _settled(edges: DataFrame) -> bool:
    """Every node points to one root, and no root points elsewhere."""
    several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    inner = edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").select("a")
    return several.unionByName(inner).isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(member, root) for every node of the pairs but the roots themselves; the root is the smallest node of its component.

    Large-star and small-star rounds: each node's neighbours are tied to the smallest of them, until only stars are left.
    Every round is written to shared storage. Nodes with very many neighbours are only ever aggregated by minimum.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    edges = stage(edges, "links")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.filter("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.withColumnRenamed("m", "b"))
        edges = stage(small.filter("a <> b").distinct(), "links")
    return edges.select(F.col("a").alias("member"), F.col("b").alias("root"))
