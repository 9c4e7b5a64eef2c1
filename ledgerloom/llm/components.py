"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b), label being the smallest node it reaches.

    Each step keeps the number of links in proportion to the input and is written to the shared folder;
    nothing comes to the driver but whether there is work left. Every minimum is pre-aggregated, so a node with very many
    links is no hot key there; minima are staged, so the join that follows is one of two tables, whose large keys Spark splits.
    """
    edges = C.stage(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = C.stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = C.stage(large, "large-star")
        C.unstage(least)
        least = C.stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select("v", "m").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = C.stage(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        C.unstage(edges, large, least)
        edges = small
    # every node points at the smallest of its component
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _stars(edges: DataFrame) -> bool:
    """No node has two links down, and none that is linked to has one."""
    several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    inner = edges.select("u").join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
    return several.unionAll(inner).isEmpty()
