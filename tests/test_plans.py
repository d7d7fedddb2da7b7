"""What the plans of the registered queries must and must not contain."""

from __future__ import annotations

import pytest
from helpers import executed_plan, rows

from propgraph import scan_rels
from propgraph.plans import tables
from propgraph.operators.write import one_per_key
from propgraph.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SLOW_PATHS = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "Window"]


def planned(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_slow_path(spark, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    plan = planned(spark, name)
    assert not [node for node in SLOW_PATHS if node in plan]


def scans(plan, table):
    return [line for line in plan.splitlines() if "FileScan" in line and f"{table}.parquet" in line]


def test_top_k_reads_the_flights_once_and_two_columns_only(spark):
    df = QUERIES["airport_top10"](spark, SF_DIR)
    df.collect()
    plan = executed_plan(df)
    (scan,) = scans(plan, "lineitem")
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in scan
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan


def test_filters_reach_the_scan(spark):
    plan = planned(spark, "node_upsert")
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThanOrEqual(c_acctbal,0.0)]" in plan


def test_hash_groups_need_no_shuffle_of_their_own(spark):
    assert planned(spark, "edge_batches").count("Exchange") == planned(spark, "ratings").count("Exchange")


def test_ends_that_exist_need_no_join(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    keyed = tables.flights(spark, SF_DIR, ["airline", "origin_airport", "destination_airport"])
    graph = tables.flight_graph(keyed, ["key"])
    # one join, to the flights for their airline; the airport's name is its key
    plan = scan_rels(graph, "FROM", ["key", "airline"], ["name"], ends_exist=True)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("SortMergeJoin") == 1


@pytest.mark.parametrize("name", ["graph_summary", "node_count", "node_append", "constraint_report", "flights_head"])
def test_the_flights_are_joined_once(spark, name):
    # what a query stages it joins in a job of its own; the plan of its answer then has no such scan
    assert len(scans(planned(spark, name), "lineitem")) <= 1


def test_set_column_is_hash_aggregated(spark):
    assert "SortAggregate" not in planned(spark, "rel_merge_keyed")


def test_two_fixed_width_columns_are_hash_aggregated(spark):
    df = spark.createDataFrame([(1, 2, None), (1, 2, 3.0), (1, None, 9.0), (2, None, 1.0), (2, None, None)], "k int, t int, r float")
    best = one_per_key(df, ["k"], ["t", "r"])
    assert rows(best) == [(1, 2, 3.0), (2, None, 1.0)]
    assert "SortAggregate" not in best._jdf.queryExecution().executedPlan().toString()
