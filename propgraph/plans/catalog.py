"""The registered queries, by name. Each takes (spark, sf_dir) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.model import End, Nodes, PropertyGraph, Rels
from propgraph.operators import batching, checks, delete, match, shape, stored, write
from propgraph.plans import tables
from propgraph.sources import buckets, store, text
from propgraph.staging import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

N_GROUPS = 64
# Batches run one after another; at this scale of data so many are enough
INGEST_GROUPS = 16
HEAD = 5000
# 1998-01-01 in epoch seconds: ratings before it count as loaded earlier
LATER_LOAD = 883612800
LATER_DAY, LATER_YEAR = "1998-01-01", 1998
# Few, for small tables: a bucket should be a few files
STORE_BUCKETS = 8

IDENTITY = ["source_id", "target_id", "timestamp"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Sources and shapes


@query
def ratings(spark, sf_dir):
    return tables.ratings(spark, sf_dir)


@query
def edge_list_csv(spark, sf_dir):
    path = new_path(spark, "edge-list")
    edges = tables.ratings(spark, sf_dir)
    edges.write.csv(path)
    return text.read_edge_list(spark, path, edges.schema).select(*tables.RATING_COLS)


@query
def flights_csv(spark, sf_dir):
    path = new_path(spark, "flights-csv")
    tables.flight_rows(spark, sf_dir).select(*tables.FLIGHT_COLS).write.csv(path, header=True)
    return text.read_table(spark, path)


@query
def sources(spark, sf_dir):
    return shape.node_set(tables.ratings(spark, sf_dir), "source_id", "source_id")


@query
def targets(spark, sf_dir):
    return shape.node_set(tables.ratings(spark, sf_dir), "target_id", "target_id")


@query
def sources_head(spark, sf_dir):
    return shape.head(sources(spark, sf_dir), ["source_id"], 5)


@query
def flights(spark, sf_dir):
    return tables.flights(spark, sf_dir)


@query
def flights_head(spark, sf_dir):
    """The first rows by key: they are found first, then numbered."""
    first = shape.head(tables.flight_rows(spark, sf_dir), tables.FLIGHT_ORDER, HEAD)
    return shape.row_key(first, tables.FLIGHT_ORDER, keep=tables.FLIGHT_COLS)


@query
def airports(spark, sf_dir):
    return tables.natural_flight_graph(spark, sf_dir).nodes["Airports"].df


@query
def flights_from(spark, sf_dir):
    keyed = tables.flights(spark, sf_dir, ["origin_airport"])
    return shape.rename(keyed, {"origin_airport": "target_name", "key": "source_key"})


@query
def flights_to(spark, sf_dir):
    keyed = tables.flights(spark, sf_dir, ["destination_airport"])
    return shape.rename(keyed, {"destination_airport": "target_name", "key": "source_key"})


@query
def flights_from_x3(spark, sf_dir):
    return shape.copies(flights_from(spark, sf_dir), 3)


# Scans, counts and top-k


@query
def node_scan(spark, sf_dir):
    keyed = tables.flights(spark, sf_dir, ["airline", "flight_number"])
    graph = PropertyGraph({"Flights": Nodes(keyed, ("key",))})
    return match.scan_nodes(graph, "Flights", ["airline", "flight_number"])


@query
def rel_scan(spark, sf_dir):
    keyed = tables.flights(spark, sf_dir, ["airline", "origin_airport", "destination_airport"])
    graph = tables.flight_graph(keyed, ["key"])
    return match.scan_rels(graph, "FROM", ["key", "airline"], ["name"])


@query
def graph_summary(spark, sf_dir):
    return match.graph_summary(tables.natural_flight_graph(spark, sf_dir, staged=True))


@query
def stored_graph_summary(spark, sf_dir):
    path = new_path(spark, "graph")
    graph = tables.flight_graph(tables.flights(spark, sf_dir), ["key"])
    store.write_graph(graph, path)
    return match.graph_summary(store.read_graph(spark, path))


@query
def stored_rel_scan(spark, sf_dir):
    """A graph opened from its folder alone, by label and type name."""
    path = new_path(spark, "graph")
    keyed = tables.flights(spark, sf_dir, ["airline", "origin_airport", "destination_airport"])
    store.write_graph(tables.flight_graph(keyed, ["key"]), path)
    return match.scan_rels(store.read_graph(spark, path), "TO", ["key", "airline"], ["name"])


@query
def node_count(spark, sf_dir):
    return match.count_nodes(tables.natural_flight_graph(spark, sf_dir, staged=True))


@query
def rel_count(spark, sf_dir):
    return match.count_rels(tables.natural_flight_graph(spark, sf_dir))


@query
def rel_count_undirected(spark, sf_dir):
    """Flights as relationships between airports, the only ones that may be loops."""
    ends = {"origin_airport": "source_name", "destination_airport": "target_name"}
    routes = shape.rename(tables.flight_rows(spark, sf_dir), ends)
    rels = Rels(routes, End("Airports", {"source_name": "name"}), End("Airports", {"target_name": "name"}))
    return match.count_rels(PropertyGraph(rels={"ROUTE": rels}), directed=False)


@query
def airport_top10(spark, sf_dir):
    graph = tables.natural_flight_graph(spark, sf_dir)
    return match.degree_top_k(graph, "Airports", "Flights", name_col="airport_name", count_col="flight_count")


@query
def airport_top10_from(spark, sf_dir):
    graph = tables.natural_flight_graph(spark, sf_dir)
    return match.degree_top_k(
        graph, "Airports", "Flights", ["FROM"], name_col="airport_name", count_col="flight_start_count"
    )


@query
def airport_top10_to(spark, sf_dir):
    graph = tables.natural_flight_graph(spark, sf_dir)
    return match.degree_top_k(
        graph, "Airports", "Flights", ["TO"], name_col="airport_name", count_col="flight_end_count"
    )


@query
def part_top10(spark, sf_dir):
    """Parts with most ratings, among very many: not every part is shuffled."""
    edges = stage(tables.ratings(spark, sf_dir).select("source_id", "target_id"), "ratings")
    graph = _rating_graph(spark, sf_dir, edges)
    names = {"name_prop": "target_id", "name_col": "target_id", "count_col": "rating_count"}
    return match.degree_top_k(graph, "Target", "Source", cells=match.CELLS, **names)


# Writes


@query
def node_upsert(spark, sf_dir):
    """Customers in credit meet those in debt and all who ordered; some are in one frame only."""
    customers = tables.table(spark, sf_dir, "customer")
    balance = F.col("c_acctbal").alias("balance")
    existing = customers.where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("source_id"), balance, F.col("c_mktsegment").alias("segment")
    )
    # the balance is unknown where all orders are filled: an incoming null
    unfilled = F.count_if(F.col("o_orderstatus") != "F") > 0
    ordered = (
        tables.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("source_id"))
        .agg(F.when(unfilled, F.max("o_totalprice")).alias("balance"))
    )
    in_debt = customers.where("c_acctbal < 0").select(F.col("c_custkey").alias("source_id"), balance)
    return write.upsert_nodes(existing, ordered.unionByName(in_debt), ["source_id"])


@query
def node_append(spark, sf_dir):
    names = stage(airports(spark, sf_dir), "airports")
    return write.append_nodes(names, names)


def _rating_end_names() -> tuple[End, End]:
    return End("Source", {"source_id": "source_id"}), End("Target", {"target_id": "target_id"})


def _rating_graph(spark, sf_dir, existing: DataFrame) -> PropertyGraph:
    """Customers in credit and all parts as nodes, ``existing`` as relationships."""
    customers = tables.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    known = customers.select(F.col("c_custkey").alias("source_id"), F.col("c_acctbal").alias("balance"))
    parts = tables.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("target_id"))
    rels = Rels(existing, *_rating_end_names())
    return PropertyGraph(
        {"Source": Nodes(known, ("source_id",)), "Target": Nodes(parts, ("target_id",))}, {"RELATES_TO": rels}
    )


@query
def endpoint_upsert(spark, sf_dir):
    """Ends of all ratings, and of customers in debt that have rated nothing: those come with a null target."""
    edges = tables.ratings(spark, sf_dir)
    in_debt = tables.table(spark, sf_dir, "customer").where("c_acctbal < 0")
    unrated = in_debt.select(F.col("c_custkey").alias("source_id"))
    graph = _rating_graph(spark, sf_dir, edges.where(F.lit(False)))
    incoming = edges.unionByName(unrated, allowMissingColumns=True)
    return write.upsert_endpoints(graph, "RELATES_TO", incoming).nodes["Source"].df


def _two_loads(spark, sf_dir) -> PropertyGraph:
    """An earlier and a later load, merged one after the other on the pair of ends."""
    edges = stage(tables.ratings(spark, sf_dir).select(*IDENTITY, "rating"), "ratings")
    graph = _rating_graph(spark, sf_dir, edges.where(F.lit(False)))
    for load in (F.col("timestamp") < LATER_LOAD, F.col("timestamp") >= LATER_LOAD):
        graph = write.upsert_rels(graph, "RELATES_TO", edges.where(load), ["timestamp", "rating"])
    return graph


@query
def rel_upsert(spark, sf_dir):
    return _two_loads(spark, sf_dir).rels["RELATES_TO"].df


@query
def rel_upsert_with_ends(spark, sf_dir):
    """Relationships and both node sets after the two loads, in one frame."""
    return _in_one_frame(_two_loads(spark, sf_dir))


def _in_one_frame(graph: PropertyGraph) -> DataFrame:
    rels = graph.rels["RELATES_TO"].df.withColumn("kind", F.lit("rel"))
    source = graph.nodes["Source"].df.select(F.lit("Source").alias("kind"), "source_id")
    target = graph.nodes["Target"].df.select(F.lit("Target").alias("kind"), "target_id")
    return rels.unionByName(source, allowMissingColumns=True).unionByName(target, allowMissingColumns=True)


def _loaded_airports(spark, sf_dir) -> DataFrame:
    """All nations; those of one region without a name yet, so no relationship finds them."""
    nations = tables.nation_regions(spark, sf_dir)
    return nations.select(F.when(F.col("region") != "AFRICA", F.col("name")).alias("name"))


@query
def rel_append_match(spark, sf_dir):
    """Three FROM per flight, to airports outside one region only; the others are not loaded."""
    keyed = tables.flights(spark, sf_dir, ["origin_airport"])
    incoming = shape.copies(shape.rename(keyed, {"key": "source_key", "origin_airport": "target_name"}), 3)
    return write.append_rels(
        incoming.where(F.lit(False)),
        incoming,
        src=(keyed, {"source_key": "key"}),
        dst=(_loaded_airports(spark, sf_dir), {"target_name": "name"}),
    )


@query
def rel_append_match_int(spark, sf_dir):
    """32-bit ids in the relationships, 64-bit keys in the nodes."""
    narrow = {c: F.col(c).cast("int") for c in ("source_id", "target_id")}
    edges = tables.ratings(spark, sf_dir).withColumns(narrow)
    parts = tables.table(spark, sf_dir, "part")
    return write.append_rels(
        edges.where(F.lit(False)),
        edges,
        src=(tables.table(spark, sf_dir, "customer"), {"source_id": "c_custkey"}),
        dst=(parts.select(F.when(F.col("p_size") <= 25, F.col("p_partkey")).alias("p_partkey")), {"target_id": "p_partkey"}),
    )


@query
def rel_merge_bare(spark, sf_dir):
    """Three FROM per flight merged by their ends alone with the TO of all flights, with nothing to set."""
    keyed = tables.flights(spark, sf_dir, ["origin_airport", "destination_airport"])
    existing = shape.rename(keyed, {"destination_airport": "target_name", "key": "source_key"})
    incoming = shape.copies(shape.rename(keyed, {"origin_airport": "target_name", "key": "source_key"}), 3)
    return write.merge_rels(existing, incoming, ["source_key", "target_name"])


@query
def rel_append_retried(spark, sf_dir):
    """The creates of ``rel_append_match``, given twice: a part got in at the first try, the second gives all."""
    keyed = tables.flights(spark, sf_dir, ["origin_airport"])
    incoming = shape.copies(shape.rename(keyed, {"key": "source_key", "origin_airport": "target_name"}), 3)
    ends = (keyed, {"source_key": "key"}), (_loaded_airports(spark, sf_dir), {"target_name": "name"})
    first = incoming.where(F.pmod("source_key", F.lit(3)) == 0)
    got_in = stage(write.append_rels(incoming.where(F.lit(False)), first, *ends, load="flights"), "got-in")
    return write.append_rels(got_in, incoming, *ends, load="flights").drop(write.REL_ID)


@query
def flights_extended(spark, sf_dir):
    """Flights before a day are loaded and keyed first; then all are, and once more."""
    rows = stage(tables.flight_rows(spark, sf_dir, bare=True), "flight-rows")
    keyed = shape.row_key(rows.where(F.col("l_shipdate") < F.lit(LATER_DAY).cast("timestamp_ntz")), tables.FLIGHT_ORDER)
    for _ in range(2):
        keyed = shape.extend_keys(keyed, rows, tables.FLIGHT_ORDER)  # all that it reads is staged
    return keyed.select("*", *tables.flight_parts()).select("key", *tables.FLIGHT_COLS)


# Stored graphs


@query
def stored_upsert(spark, sf_dir):
    """The loads of ``rel_upsert_with_ends`` into a stored graph, each a version of its own."""
    edges = stage(tables.ratings(spark, sf_dir).select(*IDENTITY, "rating"), "ratings")
    graph = _rating_graph(spark, sf_dir, edges.where(F.lit(False)))
    kept = buckets.create_store(graph, new_path(spark, "store"), STORE_BUCKETS)
    for load in (F.col("timestamp") < LATER_LOAD, F.col("timestamp") >= LATER_LOAD):
        kept = stored.upsert_stored_rels(kept, "RELATES_TO", edges.where(load), ["timestamp", "rating"])
    return _in_one_frame(kept.graph())


@query
def stored_merge_keyed(spark, sf_dir):
    """The merge of ``rel_merge_keyed`` into a stored graph."""
    edges = tables.ratings(spark, sf_dir)
    (customers, src), (parts, dst) = _rating_ends(spark, sf_dir)
    graph = PropertyGraph(
        {
            "Source": Nodes(customers.select(F.col("c_custkey").alias("source_id")), ("source_id",)),
            "Target": Nodes(parts.select(F.col("p_partkey").alias("target_id")), ("target_id",)),
        },
        {"RELATES_TO": Rels(_earlier_ratings(edges), *_rating_end_names(), tuple(IDENTITY))},
    )
    kept = buckets.create_store(graph, new_path(spark, "store"), STORE_BUCKETS)
    return stored.merge_stored_rels(kept, "RELATES_TO", edges, ["rating"]).graph().rels["RELATES_TO"].df


@query
def stored_delete(spark, sf_dir):
    """Airports of one region go with their relationships, and early flights' TO; before and after compaction."""
    nodes = Nodes(tables.nation_regions(spark, sf_dir), ("name",))
    flights_df = tables.flights(spark, sf_dir, ["year", "origin_airport", "destination_airport"])
    graph = tables.flight_graph(flights_df, ["key"]).with_nodes("Airports", nodes)
    to_rels = graph.rels["TO"]
    dated = shape.rename(flights_df, {"key": "source_key", "destination_airport": "target_name", "year": "year"})
    graph = graph.with_rels("TO", to_rels.with_df(dated))
    kept = buckets.create_store(graph, new_path(spark, "store"), STORE_BUCKETS)
    kept = stored.delete_stored_nodes(kept, "Airports", F.col("region") == "AFRICA", detach=True)
    kept = stored.delete_stored_rels(kept, "TO", F.col("year") < LATER_YEAR)
    states = {"hidden": kept, "compacted": stored.compact(kept)}
    counted = [match.graph_summary(s.graph()).select(F.lit(n).alias("state"), "kind", "name", "n") for n, s in states.items()]
    return counted[0].unionByName(counted[1])


@query
def stored_constraint(spark, sf_dir):
    """Customers in credit under a key constraint: all customers are refused, those in debt are taken."""
    customers = tables.table(spark, sf_dir, "customer")
    rows = customers.select(F.col("c_custkey").alias("source_id"), F.col("c_acctbal").alias("balance"))
    graph = PropertyGraph({"Source": Nodes(rows.where("balance >= 0"), ("source_id",))})
    kept = stored.declare(buckets.create_store(graph, new_path(spark, "store"), STORE_BUCKETS), "Source", "source_id", "key")
    try:
        kept = stored.append_stored_nodes(kept, "Source", rows)
    except stored.ConstraintError:
        kept = stored.append_stored_nodes(kept, "Source", rows.where("balance < 0"))
    return kept.graph().nodes["Source"].df


def _earlier_ratings(edges: DataFrame) -> DataFrame:
    earlier = edges.where(F.col("timestamp") < LATER_LOAD).select(*IDENTITY).distinct()
    return stage(earlier.withColumn("rating", F.lit(0).cast("float")), "earlier")


def _rating_ends(spark, sf_dir) -> tuple[write.Match, write.Match]:
    """All customers, and all parts; larger parts without a key yet, so no rating finds them."""
    parts = tables.table(spark, sf_dir, "part")
    keyed = parts.select(F.when(F.col("p_size") <= 25, F.col("p_partkey")).alias("p_partkey"))
    return (tables.table(spark, sf_dir, "customer"), {"source_id": "c_custkey"}), (keyed, {"target_id": "p_partkey"})


@query
def rel_merge_keyed(spark, sf_dir):
    """Ratings of smaller parts are set on relationships loaded earlier without one."""
    edges = tables.ratings(spark, sf_dir)
    src, dst = _rating_ends(spark, sf_dir)
    return write.merge_rels(_earlier_ratings(edges), edges, IDENTITY, ["rating"], src=src, dst=dst)


# Batches


def _batched(spark, sf_dir, n: int = N_GROUPS) -> batching.Batched:
    return batching.batch_edges(tables.ratings(spark, sf_dir), "source_id", "target_id", n)


@query
def edge_groups(spark, sf_dir):
    return batching.group_edges(tables.ratings(spark, sf_dir), "source_id", "target_id", N_GROUPS)


@query
def edge_groups_balanced(spark, sf_dir):
    edges = stage(tables.ratings(spark, sf_dir), "ratings")  # read three times
    return batching.group_edges(edges, "source_id", "target_id", N_GROUPS, balanced=True)


@query
def edge_batches(spark, sf_dir):
    return _batched(spark, sf_dir).df


@query
def batch_heatmap(spark, sf_dir):
    return batching.batch_heatmap(_batched(spark, sf_dir))


@query
def ingest_union(spark, sf_dir):
    path = new_path(spark, "ingested")
    edges = _batched(spark, sf_dir, INGEST_GROUPS)

    def write_batch(part, b):
        part.drop("batch").write.mode("overwrite").parquet(f"{path}/batch={b}")

    batching.ingest_in_batches(edges, write_batch)
    loaded = spark.read.schema(edges.df.schema).parquet(path)
    return loaded.groupBy("batch").agg(F.count("*").alias("rel_count"))


@query
def ingest_resumed(spark, sf_dir):
    """The load of ``ingest_union``, broken off in its sixth batch and gone on with by its ledger."""
    path, ledger = new_path(spark, "ingested"), new_path(spark, "ledger")
    edges = _batched(spark, sf_dir, INGEST_GROUPS)

    def write_batch(part, b):
        part.drop("batch").write.mode("overwrite").parquet(f"{path}/batch={b}")

    def broken_off(part, b):
        if b == 5:
            raise InterruptedError
        write_batch(part, b)

    try:
        batching.ingest_in_batches(edges, broken_off, ledger)
    except InterruptedError:
        batching.ingest_in_batches(edges, write_batch, ledger)
    loaded = spark.read.schema(edges.df.schema).parquet(path)
    return loaded.groupBy("batch").agg(F.count("*").alias("rel_count"))


@query
def ingest_merge_keyed(spark, sf_dir):
    """The merge of ``rel_merge_keyed``, batch by batch."""
    edges = stage(tables.ratings(spark, sf_dir), "ratings")
    src, dst = _rating_ends(spark, sf_dir)
    batched = batching.batch_edges(edges, "source_id", "target_id", INGEST_GROUPS)
    return batching.merge_in_batches(
        _earlier_ratings(edges), batched, "source_id", "target_id", IDENTITY, ["rating"], new_path(spark, "merged"), src, dst
    )


@query
def ingest_append_match(spark, sf_dir):
    """The creates of ``rel_append_match``, batch by batch: string targets, few and hot, three copies of each edge."""
    keyed = tables.flights(spark, sf_dir, ["origin_airport"])
    edges = shape.copies(shape.rename(keyed, {"key": "source_key", "origin_airport": "target_name"}), 3)
    batched = batching.batch_edges(edges, "source_key", "target_name", INGEST_GROUPS)
    src, dst = (keyed, {"source_key": "key"}), (_loaded_airports(spark, sf_dir), {"target_name": "name"})
    loaded = batching.append_in_batches(batched, new_path(spark, "created"), src, dst)
    return loaded.select("source_key", "target_name")


# Checks and deletes


def _loaded_twice(spark, sf_dir, names: DataFrame) -> DataFrame:
    """The airports, and all nations appended once more: under the same name, without one, or under another."""
    again = tables.nation_regions(spark, sf_dir)
    other = F.when(F.col("region") != "EUROPE", F.concat(F.lit("NEW "), F.col("name")))
    named = again.select(F.when(F.col("region") == "ASIA", F.col("name")).otherwise(other).alias("name"))
    return write.append_nodes(names, named)


@query
def unique_violations(spark, sf_dir):
    return checks.unique_violations(_loaded_twice(spark, sf_dir, airports(spark, sf_dir)), "name")


@query
def key_violations(spark, sf_dir):
    return checks.key_violations(_loaded_twice(spark, sf_dir, airports(spark, sf_dir)), "name")


@query
def constraint_report(spark, sf_dir):
    ends = ["origin_airport", "destination_airport"]
    keyed = tables.flights(spark, sf_dir, ends)
    twice = _loaded_twice(spark, sf_dir, shape.node_set(keyed, ends, "name"))
    graph = PropertyGraph({"Airports": Nodes(twice, ("name",)), "Flights": Nodes(keyed, ("key",))})
    declared = [("Airports", "name", "unique"), ("Airports", "name", "key"), ("Flights", "key", "unique")]
    return checks.constraint_report(graph, declared)


def _rels_by_type(graph: PropertyGraph) -> DataFrame:
    return match.graph_summary(replace(graph, nodes={})).select(
        F.col("name").alias("type"), F.col("n").alias("rel_count")
    )


@query
def delete_rels(spark, sf_dir):
    return _rels_by_type(delete.delete_rels(tables.natural_flight_graph(spark, sf_dir), "FROM"))


@query
def detach_delete(spark, sf_dir):
    nodes = Nodes(tables.nation_regions(spark, sf_dir), ("name",))
    graph = tables.natural_flight_graph(spark, sf_dir).with_nodes("Airports", nodes)
    return _rels_by_type(delete.delete_nodes(graph, "Airports", F.col("region") == "AFRICA", detach=True))


@query
def plain_delete(spark, sf_dir):
    """All relationships first, then the airports of one region, which need no detaching now."""
    nodes = Nodes(tables.nation_regions(spark, sf_dir), ("name",))
    graph = tables.natural_flight_graph(spark, sf_dir).with_nodes("Airports", nodes)
    bare = delete.delete_rels(graph)
    return match.graph_summary(delete.delete_nodes(bare, "Airports", F.col("region") == "AFRICA"))


@query
def delete_everything(spark, sf_dir):
    """All nodes go, and all relationships with them."""
    graph = tables.natural_flight_graph(spark, sf_dir)
    return match.graph_summary(delete.delete_nodes(graph, detach=True))
