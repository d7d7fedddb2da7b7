from __future__ import annotations

import random

import pytest
from helpers import rows, shuffled_rows
from pyspark.sql import functions as F

from propgraph import (
    End,
    Nodes,
    Pool,
    PropertyGraph,
    Rels,
    count_nodes,
    count_rels,
    degree_top_k,
    graph_summary,
    read_graph,
    scan_nodes,
    scan_rels,
    write_graph,
)
from propgraph.operators import match


@pytest.fixture
def routes(spark):
    df = spark.createDataFrame([("A", "A", 1), ("A", "B", 2)], "source_name string, target_name string, miles int")
    airports = Nodes(spark.createDataFrame([("A",), ("B",)], "name string"), ("name",))
    rels = Rels(df, End("Airports", {"source_name": "name"}), End("Airports", {"target_name": "name"}))
    return PropertyGraph({"Airports": airports}, {"ROUTE": rels})


@pytest.fixture
def flights(spark):
    """Three flights; FROM and TO share a pool, as they do in a stored graph."""
    nodes = spark.createDataFrame([(0, "x"), (1, "y"), (2, "x")], "key bigint, airline string")
    airports = spark.createDataFrame([(1, "B"), (2, "A"), (3, "A")], "id int, name string")
    both = spark.createDataFrame(
        [(0, 1, "FROM"), (1, 1, "FROM"), (2, 2, "FROM"), (0, 2, "TO"), (1, 3, "TO"), (2, 1, "TO"), (2, 1, "OTHER")],
        "source_key bigint, target_id int, type string",
    )
    ends = End("Flights", {"source_key": "key"}), End("Airports", {"target_id": "id"})
    pool = Pool(both, "type")
    rels = {t: Rels(both.where(f"type = '{t}'").drop("type"), *ends, pool=pool) for t in ("FROM", "TO")}
    return PropertyGraph({"Flights": Nodes(nodes, ("key",)), "Airports": Nodes(airports, ("id",))}, rels)


def test_counts_with_a_loop(routes):
    assert rows(count_rels(routes)) == [(2,)]
    assert rows(count_rels(routes, directed=False)) == [(3,)]
    assert rows(count_nodes(routes)) == [(2,)]


def test_counts_of_a_pool_ignore_other_types(flights):
    assert rows(count_rels(flights)) == [(6,)]
    assert rows(count_rels(flights, directed=False)) == [(12,)]
    assert rows(graph_summary(flights)) == [
        ("node", "Airports", 3),
        ("node", "Flights", 3),
        ("rel", "FROM", 3),
        ("rel", "TO", 3),
    ]


def test_counts_without_relationships(flights):
    bare = PropertyGraph(flights.nodes, {})
    assert rows(count_rels(bare)) == [(0,)]
    assert rows(count_nodes(flights)) == [(6,)]


def test_summary_lists_empty_types(flights):
    rels = flights.rels["FROM"]
    graph = PropertyGraph(rels={"FROM": rels.with_df(rels.df.where("false"))})
    assert rows(graph_summary(graph)) == [("rel", "FROM", 0)]


def test_degree_groups_by_name_and_breaks_ties_by_name(flights):
    # two airports are called A
    assert degree_top_k(flights, "Airports", "Flights").collect() == [("A", 3), ("B", 3)]
    assert degree_top_k(flights, "Airports", "Flights", ["FROM"]).collect() == [("B", 2), ("A", 1)]
    assert degree_top_k(flights, "Airports", "Flights", ["TO"], k=1, name_col="a", count_col="c").collect() == [("A", 2)]


def test_degree_works_from_either_end(flights):
    by_airline = degree_top_k(flights, "Flights", "Airports", name_prop="airline")
    assert by_airline.collect() == [("x", 4), ("y", 2)]
    assert degree_top_k(flights, "Airports", "Airports").collect() == []


def test_degree_between_nodes_of_one_label_meets_a_loop_once(routes):
    assert degree_top_k(routes, "Airports", "Airports").collect() == [("A", 2), ("B", 1)]


def test_scans(flights):
    assert scan_nodes(flights, "Flights", ["airline"]).columns == ["key", "airline"]
    assert rows(scan_nodes(flights, "Airports")) == [(1, "B"), (2, "A"), (3, "A")]
    out = scan_rels(flights, "FROM", ["airline", "key"], ["name"])
    assert out.columns == ["source_airline", "source_key", "target_name"]
    assert rows(out) == [("x", 0, "B"), ("x", 2, "A"), ("y", 1, "B")]
    keys = scan_rels(flights, "TO", ["key"], ["id"])
    assert rows(keys) == [(0, 2), (1, 3), (2, 1)]


@pytest.fixture
def torn(spark):
    """Relationships with null ends, and with an end that is not among the nodes."""
    df = spark.createDataFrame(
        [("A", "B", 1), ("A", None, 2), (None, "B", 3), (None, None, 4), ("A", "Z", 5)],
        "source_name string, target_name string, miles int",
    )
    airports = Nodes(spark.createDataFrame([("A",), ("B",), (None,)], "name string"), ("name",))
    rels = Rels(df, End("Airports", {"source_name": "name"}), End("Airports", {"target_name": "name"}))
    return PropertyGraph({"Airports": airports}, {"ROUTE": rels})


def test_null_ends_are_not_counted_or_ranked(torn):
    assert rows(count_rels(torn)) == [(2,)]
    assert rows(count_rels(torn, directed=False)) == [(4,)]
    assert ("rel", "ROUTE", 2) in rows(graph_summary(torn))
    assert degree_top_k(torn, "Airports", "Airports").collect() == [("A", 3), ("B", 2), ("Z", 1)]


def test_scans_give_the_same_rows_whatever_is_asked_for(spark, torn):
    named = spark.createDataFrame([("A", 1), ("B", 2)], "name string, size int")
    graph = torn.with_nodes("Airports", Nodes(named, ("name",)))
    assert rows(scan_rels(graph, "ROUTE", ["name"], ["name"])) == [("A", "B", 1)]
    assert rows(scan_rels(graph, "ROUTE", ["size"], ["size"])) == [(1, 2, 1)]
    assert rows(scan_rels(graph, "ROUTE", ["name"], ["name"], ends_exist=True)) == [("A", "B", 1), ("A", "Z", 5)]


def test_an_empty_graph_has_no_answer():
    with pytest.raises(ValueError, match="neither"):
        count_nodes(PropertyGraph())


def test_scan_keeps_relationship_properties(routes):
    out = scan_rels(routes, "ROUTE")
    assert out.columns == ["source_name", "target_name", "miles"]
    assert rows(out) == [("A", "A", 1), ("A", "B", 2)]


def test_stored_graph_reads_back_equal(spark, flights, routes, tmp_path):
    for i, graph in enumerate((flights, routes)):
        path = str(tmp_path / str(i))
        write_graph(graph, path)
        back = read_graph(spark, path)
        assert rows(graph_summary(back)) == rows(graph_summary(graph))
        for name, rels in graph.rels.items():
            assert back.rels[name].df.columns == rels.df.columns
            assert rows(back.rels[name].df) == rows(rels.df)


def test_one_type_of_a_stored_pool_reads_one_folder(spark, flights, tmp_path):
    write_graph(flights, str(tmp_path / "g"))
    back = read_graph(spark, str(tmp_path / "g"))
    plan = back.rels["TO"].df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan and "= TO)" in plan


def test_a_pool_holds_relationships_between_the_same_ends_only(flights):
    other = Rels(flights.rels["TO"].df, *[End("Airports", {c: "id"}) for c in ("source_key", "target_id")])
    with pytest.raises(ValueError, match="pool"):
        flights.with_rels("NEAR", other.with_df(other.df, flights.rels["FROM"].pool))


def test_top_k_of_very_many_names(spark, tmp_path):
    """A million names, few of them frequent: the same answer, and a tenth of the rows shuffled."""
    names = spark.range(0, 2_000_000, 1, 8).select(
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("hub"), F.floor(F.sqrt(F.col("id") % 400)).cast("string")))
        .otherwise(F.concat(F.lit("n"), (F.xxhash64("id") % 500_000).cast("string")))
        .alias("name")
    )
    path = str(tmp_path / "names")
    names.unionByName(spark.createDataFrame([(None,)] * 9, "name string")).write.parquet(path)
    df = spark.read.parquet(path)
    plain = df.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(10)
    want = plain.collect()
    assert df.select("name").distinct().count() > 700_000
    phases = [match.cell_totals(df, "name", 1 << 12), match.frequent_top_k(df, "name", 10, cells=1 << 12)]
    assert phases[1].collect() == want
    phases[0].collect()
    assert 10 * sum(shuffled_rows(p) for p in phases) < shuffled_rows(plain)


@pytest.mark.parametrize("cells", [1, 7, 1 << 12])
def test_top_k_by_cells_equals_the_plain_one(spark, cells):
    draw = random.Random(cells)
    values = [draw.choice([None, *range(30)]) for _ in range(300)] + [float("-0.0"), 0.0]
    df = spark.createDataFrame([(None if v is None else float(v), 1) for v in values], "v double, _cell int")
    for k in (1, 5, 100):
        plain = df.where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "v").limit(k)
        assert match.frequent_top_k(df, "v", k, cells=cells).collect() == plain.collect()
    assert match.frequent_top_k(df.limit(0), "v", 3).collect() == []
