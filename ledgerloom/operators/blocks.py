"""Components of rows that share keys, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.lineage import drop, keep


def labels(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v): the smallest node that it reaches.

    Large stars tie a node's larger neighbours to its smallest one, small stars the smaller ones; after a few rounds, a logarithm of the longest
    chain, only stars are left. Minima are pre-aggregated and written, so a node with very many neighbours is a key of a join that Spark splits.
    """
    now = keep(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        twice = now.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        chained = now.select("u").join(now.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        if twice.unionAll(chained).isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = keep(both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        lower = keep(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(lower, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = keep(small.unionAll(lower.select("u", F.col("m").alias("v"))).distinct())
        drop(now, lowest, large, lower)
        now = after


def components(links: DataFrame) -> DataFrame:
    """(side, ord, component) for (side, ord, key), side 0 or 1: rows are together if a chain of shared keys joins them."""
    rows = keep(links.select("side", "ord", (F.col("ord") * 2 + F.col("side")).alias("id"), "key").distinct())
    hub = keep(rows.groupBy("key").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "v"))
    found = labels(rows.join(hub, "key").select(F.col("id").alias("u"), "v"))
    own = rows.select("side", "ord", "id").distinct()
    return own.join(found, F.col("id") == F.col("node"), "left").select("side", "ord", F.coalesce("label", "id").alias("component"))
