"""From a CSV file to a stored graph, changes to it, and a parallel load, as the README shows it."""

from __future__ import annotations

from helpers import rows
from pyspark.sql import functions as F

import propgraph as pg

SCHEMA = "year int, month int, day int, airline string, flight_number int, origin_airport string, destination_airport string"
LINES = """year,month,day,airline,flight_number,origin_airport,destination_airport
2015,1,1,AA,10,DFW,LAX
2015,1,1,AA,11,DFW,SEA
2015,1,2,BB,10,LAX,DFW
2015,1,2,BB,12,SEA,SEA
"""


def test_flow(spark, tmp_path):
    (tmp_path / "flights.csv").write_text(LINES)
    table = pg.read_table(spark, str(tmp_path / "flights.csv"), SCHEMA)
    flights = pg.row_key(table, ["year", "month", "day", "airline", "flight_number"])
    airports = pg.node_set(flights, ["origin_airport", "destination_airport"], "name")
    ends = pg.End("Flights", {"source_key": "key"}), pg.End("Airports", {"target_name": "name"})
    from_rels = pg.rename(flights, {"key": "source_key", "origin_airport": "target_name"})
    to_rels = pg.rename(flights, {"key": "source_key", "destination_airport": "target_name"})
    graph = pg.PropertyGraph(
        {"Flights": pg.Nodes(flights, ("key",)), "Airports": pg.Nodes(airports, ("name",))},
        {"FROM": pg.Rels(from_rels, *ends), "TO": pg.Rels(to_rels, *ends)},
    )
    pg.write_graph(graph, str(tmp_path / "v1"))
    graph = pg.read_graph(spark, str(tmp_path / "v1"))

    assert pg.degree_top_k(graph, "Airports", "Flights", k=2).collect() == [("DFW", 3), ("SEA", 3)]
    assert rows(pg.scan_rels(graph, "FROM", ["key", "airline"], ["name"])) == [
        (0, "AA", "DFW"),
        (1, "AA", "DFW"),
        (2, "BB", "LAX"),
        (3, "BB", "SEA"),
    ]
    checks = [("Airports", "name", "key"), ("Flights", "key", "unique")]
    assert {r["violations"] for r in pg.constraint_report(graph, checks).collect()} == {0}

    # a repeated relationship changes nothing, a new one brings its ends along
    more = spark.createDataFrame([(0, "DFW"), (9, "JFK")], "source_key bigint, target_name string")
    graph = pg.upsert_rels(graph, "FROM", more)
    counts = {r["name"]: r["n"] for r in pg.graph_summary(graph).collect()}
    assert counts == {"Flights": 5, "Airports": 4, "FROM": 5, "TO": 4}

    graph = pg.delete_nodes(graph, "Airports", F.col("name") == "SEA", detach=True)
    counts = {r["name"]: r["n"] for r in pg.graph_summary(graph).collect()}
    assert counts == {"Flights": 5, "Airports": 3, "FROM": 4, "TO": 2}

    n = 3
    batched = pg.batch_edges(graph.rels["FROM"].df, "source_key", "target_name", n)
    pg.ingest_in_batches(batched, lambda part, b: part.write.parquet(f"{tmp_path}/load/{b}"))
    loaded = spark.read.parquet(*[f"{tmp_path}/load/{b}" for b in range(n)])
    assert rows(loaded, "source_key", "target_name") == rows(graph.rels["FROM"].df)
