"""Connected components by alternating large-star and small-star steps.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each step is
an aggregate and a join over the links; each result is written, so that the plan stays
small and a lost executor costs a re-read. Nothing is collected but whether a step has moved any link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.operators.joins import hub_join
from propgraph.staging import new_path, stage, staging, write_once


def _both_ways(links: DataFrame) -> DataFrame:
    there = F.struct(F.col("a").alias("u"), F.col("b").alias("v"))
    back = F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
    return links.select(F.inline(F.array(there, back)))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each u below the smallest of u and its neighbours: a, b, moved (whether that is new).

    The large step moves the neighbours above u, the small one those below, and u itself.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        joined = hub_join(pairs.where("v > u"), least.withColumn("m", F.least("m", "u")), ["u"], "inner")
        return joined.select(F.col("v").alias("a"), F.col("m").alias("b"), (F.col("m") != F.col("u")).alias("moved"))
    # u itself comes from the row of its smallest neighbour
    joined = hub_join(pairs, least, ["u"], "inner").withColumn("moved", F.col("v") != F.col("m"))
    moved = joined.select(F.when(F.col("moved"), F.col("v")).otherwise(F.col("u")).alias("a"), F.col("m").alias("b"), "moved")
    return moved.groupBy("a", "b").agg(F.max("moved").alias("moved"))


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to one row per linked node: node, component, its smallest node.

    Loops, repeated links and links with a null end add nothing.
    """
    spark, path = links.sparkSession, new_path(links.sparkSession, "components")
    with staging(spark):
        return write_once(_stars(links), path)


def _stars(links: DataFrame) -> DataFrame:
    ordered = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(links.where("a <> b").select(F.inline(F.array(ordered))).distinct(), "links")
    settled, single = links.isEmpty(), False
    # if no node has two smaller neighbours and none with larger ones has a smaller one, all are stars
    while not settled:
        large = stage(_star(_both_ways(links), large=True), "links")
        flat = large.where("moved").isEmpty()
        if flat and single:
            break
        links = stage(_star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), large=False), "links")
        single = links.where("moved").isEmpty()
        settled = flat and single
    roots = links.select(F.col("b").alias("node")).distinct()
    below = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return below.unionByName(roots.withColumn("component", F.col("node")))
