"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialise


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b).

    Every step joins each node's neighbours to the smallest one by an
    aggregation and a join, written to the shared folder; no component is ever
    gathered in one task. Stops when a round changes nothing.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct(), label)
    while True:
        # large-star: greater neighbours move to the smallest of the neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small-star: smaller neighbours and the node itself move to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        fresh = materialise(small, label)
        # stars already: nothing is both a centre and a leaf, and every leaf has one centre
        open_ends = fresh.select("v").distinct().join(fresh.select(F.col("u").alias("v")).distinct(), "v")
        many = fresh.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
        edges = fresh
        if open_ends.select(F.lit(1)).unionAll(many.select(F.lit(1))).limit(1).count() == 0:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
