"""The given tables shaped as the two graphs: customers rating parts, flights between nations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.model import End, Nodes, Pool, PropertyGraph, Rels
from propgraph.operators.shape import node_set, row_key
from propgraph.staging import stage

# Unique together in lineitem; (l_orderkey, l_linenumber) alone is not.
FLIGHT_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
FLIGHT_COLS = ["year", "month", "day", "airline", "flight_number", "origin_airport", "destination_airport"]
RATING_COLS = ["source_id", "target_id", "rating", "timestamp"]


# Columns and types of the given tables, as far as they are used. Stating them spares
# the job that reads a footer each time a table is opened.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds(col: str) -> Column:
    """Seconds since 1970 of a timestamp without zone, whatever the session time zone."""
    return F.unix_date(F.to_date(col)) * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges customer -> part; the timestamp is in epoch seconds."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("source_id"),
        F.col("l_partkey").alias("target_id"),
        F.col("l_quantity").cast("float").alias("rating"),
        _epoch_seconds("l_shipdate").cast("int").alias("timestamp"),
    )


def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as airports: name, region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select(F.col("n_name").alias("name"), F.col("r_name").alias("region"))


def flight_rows(spark: SparkSession, sf_dir: str, bare: bool = False) -> DataFrame:
    """Shipments as flights from the supplier's to the customer's nation, with their natural key.

    ``bare``: without ``flight_parts``, for rows that are shuffled again.

    The orders go first, so the wide side is shuffled for them without any names. Suppliers and
    nations are joined one by one: Spark knows their sizes and broadcasts them while they are small.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("airline"), "s_nationkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(*FLIGHT_ORDER)

    origins = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin_airport"))
    homes = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("destination_airport"))
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    joined = joined.join(origins, "s_nationkey").join(homes, "c_nationkey")
    parts = [] if bare else flight_parts()
    return joined.select(*FLIGHT_ORDER, *parts, "airline", "origin_airport", "destination_airport")


def flight_parts() -> list[Column]:
    """The columns of a flight that its natural key implies."""
    parts = {"year": F.year("l_shipdate"), "month": F.month("l_shipdate"), "day": F.day("l_shipdate")}
    return [c.alias(name) for name, c in (parts | {"flight_number": F.col("l_linenumber")}).items()]


def flights(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """Flights under a dense bigint key; runs the numbering when called."""
    return row_key(flight_rows(spark, sf_dir), FLIGHT_ORDER, keep=cols or FLIGHT_COLS)


def flight_graph(flights_df: DataFrame, keys: list[str]) -> PropertyGraph:
    """Flights and airports joined by FROM and TO; ``keys`` identify a flight.

    Questions that never show a flight's key use the natural key, which costs nothing.
    """
    source = End("Flights", {f"source_{k}": k for k in keys})
    target = End("Airports", {"target_name": "name"})
    source_cols = [F.col(k).alias(c) for c, k in source.cols.items()]
    ends = {"FROM": "origin_airport", "TO": "destination_airport"}

    # both types in one pass over the flights
    pairs = F.array(*[F.struct(F.lit(t).alias("type"), F.col(c).alias("target_name")) for t, c in ends.items()])
    pool = Pool(flights_df.select(*source_cols, F.inline(pairs)), "type")
    rels = {
        rel_type: Rels(flights_df.select(*source_cols, F.col(c).alias("target_name")), source, target, pool=pool)
        for rel_type, c in ends.items()
    }
    nodes = {
        "Flights": Nodes(flights_df, tuple(keys)),
        "Airports": Nodes(node_set(flights_df, list(ends.values()), "name"), ("name",)),
    }
    return PropertyGraph(nodes, rels)


def natural_flight_graph(spark: SparkSession, sf_dir: str, staged: bool = False) -> PropertyGraph:
    """``staged``: for questions with several reads, so that the joins behind the flights run once."""
    rows = flight_rows(spark, sf_dir)
    if staged:
        rows = stage(rows.select(*FLIGHT_ORDER, "origin_airport", "destination_airport"), "flights")
    return flight_graph(rows, FLIGHT_ORDER)
