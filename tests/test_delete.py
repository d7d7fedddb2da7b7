from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from propgraph import End, Nodes, Pool, PropertyGraph, Rels, delete_nodes, delete_rels, graph_summary


@pytest.fixture
def graph(spark):
    flights = spark.createDataFrame([(0, 5), (1, None), (2, 7)], "key int, size int")
    airports = spark.createDataFrame([("A", "x"), ("B", "y"), ("C", None)], "name string, region string")
    both = spark.createDataFrame(
        [(0, "A", "FROM"), (1, "B", "FROM"), (2, "A", "FROM"), (0, "B", "TO"), (1, "B", "TO"), (2, "A", "TO")],
        "source_key int, target_name string, type string",
    )
    pool = Pool(both, "type")
    ends = End("Flights", {"source_key": "key"}), End("Airports", {"target_name": "name"})
    rels = {t: Rels(both.where(F.col("type") == t).drop("type"), *ends, pool=pool) for t in ("FROM", "TO")}
    return PropertyGraph({"Flights": Nodes(flights, ("key",)), "Airports": Nodes(airports, ("name",))}, rels)


def counts(graph):
    return {r["name"]: r["n"] for r in graph_summary(graph).collect()}


def test_delete_rels(graph):
    assert counts(delete_rels(graph)) == {"Flights": 3, "Airports": 3, "FROM": 0, "TO": 0}
    assert counts(delete_rels(graph, "FROM")) == {"Flights": 3, "Airports": 3, "FROM": 0, "TO": 3}
    some = delete_rels(graph, where=F.col("target_name") == "A")
    assert counts(some) == {"Flights": 3, "Airports": 3, "FROM": 1, "TO": 2}
    assert some.rels["FROM"].pool is some.rels["TO"].pool is not None


def test_plain_delete_raises_while_relationships_remain(graph):
    with pytest.raises(ValueError, match="relationships"):
        delete_nodes(graph, "Airports")
    with pytest.raises(ValueError, match="relationships"):
        delete_nodes(graph, "Airports", F.col("region") == "y")
    with pytest.raises(ValueError, match="relationships"):
        delete_nodes(graph)
    assert counts(delete_nodes(delete_rels(graph))) == {"Flights": 0, "Airports": 0, "FROM": 0, "TO": 0}


def test_plain_delete_of_nodes_without_relationships(graph):
    out = delete_nodes(graph, "Airports", F.col("name") == "C")
    assert rows(out.nodes["Airports"].df, "name") == [("A",), ("B",)]


def test_condition_that_is_null_deletes_nothing(graph):
    out = delete_nodes(graph, "Flights", F.col("size") > 6, detach=True)
    assert rows(out.nodes["Flights"].df, "key") == [(0,), (1,)]


def test_detach_delete_leaves_no_dangling_end(graph):
    out = delete_nodes(graph, "Airports", F.col("region") == "x", detach=True)
    assert counts(out) == {"Flights": 3, "Airports": 2, "FROM": 1, "TO": 2}
    names = {r[0] for r in out.nodes["Airports"].df.select("name").collect()}
    for rels in out.rels.values():
        assert {r[0] for r in rels.df.select("target_name").collect()} <= names


def test_detach_delete_of_a_label_and_of_everything(graph):
    assert counts(delete_nodes(graph, "Flights", detach=True)) == {"Flights": 0, "Airports": 3, "FROM": 0, "TO": 0}
    assert counts(delete_nodes(graph, detach=True)) == {"Flights": 0, "Airports": 0, "FROM": 0, "TO": 0}


def test_delete_on_both_ends_of_one_label(spark):
    nodes = spark.createDataFrame([("A",), ("B",), ("C",)], "name string")
    routes = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "B"), ("B", "B")], "source_name string, target_name string")
    rels = Rels(routes, End("N", {"source_name": "name"}), End("N", {"target_name": "name"}))
    graph = PropertyGraph({"N": Nodes(nodes, ("name",))}, {"R": rels})
    out = delete_nodes(graph, "N", F.col("name") == "A", detach=True)
    assert rows(out.rels["R"].df) == [("B", "B"), ("B", "C"), ("C", "B")]
    out = delete_nodes(graph, "N", F.col("name") == "C", detach=True)
    assert rows(out.rels["R"].df) == [("A", "B"), ("B", "B")]
