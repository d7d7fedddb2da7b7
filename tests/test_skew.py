"""One key holds a third of all rows: the join that meets it must be split."""

from __future__ import annotations

import pytest
from helpers import executed_plan, rows
from pyspark.sql import functions as F

from propgraph import End, Nodes, PropertyGraph, Rels, append_rels, delete_nodes, node_set, upsert_nodes
from propgraph.operators.joins import hub_join


@pytest.fixture
def as_at_scale(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", 2)
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")


@pytest.fixture
def hub(spark):
    """30,000 edges in 8 partitions; source 1 has a third of them."""
    ids = spark.range(0, 30000, 1, 8)
    source = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 2)
    return ids.select(source.alias("source_id"), (F.col("id") * 7).alias("target_id"))


def is_split(df):
    df.collect()
    return "SortMergeJoin(skew=true)" in executed_plan(df)


def test_match_against_an_aggregate_is_split(as_at_scale, hub):
    nodes = node_set(hub, "source_id", "id")
    df = append_rels(hub.where(F.lit(False)), hub, src=(nodes, {"source_id": "id"}))
    assert is_split(df)
    assert df.count() == 30000


def test_the_plain_join_would_not_be(as_at_scale, hub):
    nodes = node_set(hub, "source_id", "source_id")
    assert not is_split(hub.join(nodes, "source_id"))


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_other_joins_are_split(as_at_scale, hub, how):
    nodes = node_set(hub.where("source_id < 20000"), "source_id", "source_id")
    if how == "left":  # without a column of its own the right side would be optimized away
        nodes = nodes.withColumn("seen", F.lit(True))
    assert is_split(hub_join(hub, nodes, ["source_id"], how))


def test_upsert_over_many_copies_of_a_key_is_split(as_at_scale, hub):
    incoming = hub.select("source_id", F.lit(5).cast("bigint").alias("target_id")).where("source_id < 100")
    df = upsert_nodes(hub, incoming, ["source_id"])
    assert is_split(df)
    assert df.where("source_id = 1").select("target_id").distinct().collect() == [(5,)]
    assert df.count() == 30000


def test_detach_delete_is_split(as_at_scale, hub):
    nodes = Nodes(node_set(hub, "source_id", "id"), ("id",))
    rels = Rels(hub, End("N", {"source_id": "id"}), End("M", {"target_id": "id"}))
    graph = PropertyGraph({"N": nodes}, {"R": rels})
    out = delete_nodes(graph, "N", F.col("id") > 15000, detach=True).rels["R"].df
    assert is_split(out)
    assert rows(out) == rows(hub.where("source_id <= 15000"))


def test_copies_are_combined_before_the_shuffle(spark):
    df = upsert_nodes(
        spark.createDataFrame([], "k int, v int"),
        spark.range(0, 100000, 1, 4).select(F.lit(1).alias("k"), F.lit(2).alias("v")),
        ["k"],
    )
    assert rows(df) == [(1, 2)]
