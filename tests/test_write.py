from __future__ import annotations

import random

import pytest
from helpers import executed_plan, rows
from pyspark.sql import functions as F

from propgraph import (
    End,
    Nodes,
    PropertyGraph,
    Rels,
    append_nodes,
    append_rels,
    merge_rels,
    unique_violations,
    upsert_endpoints,
    upsert_nodes,
    upsert_rels,
    with_rel_ids,
)
from propgraph.operators.joins import hub_join
from propgraph.staging import stage

PAIR = ["source_id", "target_id"]
KEYED = [*PAIR, "timestamp"]


@pytest.fixture
def dup(edges):
    return edges((1, 10, 5.0, 100), (1, 10, 2.0, 100), (1, 10, 2.0, 101))


def test_upsert_nodes_overwrites_with_null_and_keeps_absent_columns(spark):
    old = spark.createDataFrame([(1, 1, "x"), (2, 2, "y")], "id int, a int, b string")
    new = spark.createDataFrame([(2, None), (3, 3)], "id int, a int")
    out = upsert_nodes(old, new, ["id"])
    assert out.columns == ["id", "a", "b"]
    assert rows(out) == [(1, 1, "x"), (2, None, "y"), (3, 3, None)]
    assert rows(upsert_nodes(out, new, ["id"])) == rows(out)


def test_upsert_nodes_adds_new_columns_at_the_end(spark):
    old = spark.createDataFrame([(1, 1)], "id int, a int")
    new = spark.createDataFrame([(1, "p"), (2, "q")], "id int, c string")
    out = upsert_nodes(old, new, ["id"])
    assert out.columns == ["id", "a", "c"]
    assert rows(out) == [(1, 1, "p"), (2, None, "q")]


def test_upsert_nodes_picks_the_greatest_row_and_drops_null_keys(spark):
    old = spark.createDataFrame([(1, 0, 0)], "id int, a int, b int")
    new = spark.createDataFrame([(1, 5, 1), (1, 4, 2), (None, 9, 9)], "id int, a int, b int")
    assert rows(upsert_nodes(old, new, ["id"])) == [(1, 5, 1)]
    assert rows(upsert_nodes(old, new, ["id"], order=["b"])) == [(1, 4, 2)]


def test_upsert_updates_each_of_several_existing_nodes_of_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "z")], "id int, v string")
    assert rows(upsert_nodes(old, new, ["id"])) == [(1, "z"), (1, "z"), (None, "c")]


@pytest.mark.parametrize("bulk", [False, True])
@pytest.mark.parametrize("threshold", [-1, 10 << 20])
def test_upsert_gives_the_same_rows_by_every_plan(spark, conf, bulk, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (None, "c", 1), (4, "d", 1)], "k int, v string, w int")
    new = spark.createDataFrame([(1, None), (2, "n"), (None, "x")], "k bigint, v string")
    want = [(1, None, 1), (1, None, 1), (2, "n", None), (4, "d", 1), (None, "c", 1)]
    assert rows(upsert_nodes(old, new, ["k"], bulk=bulk)) == want


@pytest.mark.parametrize("threshold", [-1, 10 << 20])
def test_upsert_of_keys_of_another_type(spark, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    old = spark.range(1000).selectExpr("cast(id AS int) AS k", "1 AS v")
    df = upsert_nodes(old, spark.range(500, 1500).selectExpr("id AS k", "2 AS v"), ["k"])
    assert df.count() == 1500
    assert df.agg(F.sum("v")).collect() == [(2500,)]


@pytest.mark.parametrize("columns", [["k", "v"], ["k"]])
def test_chained_upserts_grow_by_one_plan_each(spark, columns):
    graph = spark.range(10).selectExpr("id AS k", "0 AS v")
    leaves = []
    for i in range(1, 7):
        batch = spark.range(i, 10 + i).selectExpr("id AS k", f"{i} AS v").select(*columns)
        graph = upsert_nodes(graph, batch, ["k"])
        leaves.append(graph._jdf.queryExecution().optimizedPlan().collectLeaves().size())
    steps = {b - a for a, b in zip(leaves, leaves[1:], strict=False)}
    assert max(steps) <= 2
    assert graph.count() == 16


def test_small_batch_leaves_the_graph_unshuffled(spark):
    old = spark.range(100).selectExpr("id AS k", "1 AS v")
    df = upsert_nodes(old, spark.range(50, 150).selectExpr("id AS k", "2 AS v"), ["k"])
    df.collect()
    plan = executed_plan(df)
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") <= 1


def test_upsert_by_two_keys_and_with_keys_only(spark):
    old = spark.createDataFrame([(1, "a", 1)], "x int, y string, v int")
    new = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (1, None, 4)], "x int, y string, v int")
    assert rows(upsert_nodes(old, new, ["x", "y"])) == [(1, "a", 2), (1, "b", 3)]
    assert rows(upsert_nodes(old, new.select("x", "y"), ["x", "y"])) == [(1, "a", 1), (1, "b", None)]


def test_append_nodes_is_a_bag_union(spark):
    old = spark.createDataFrame([(1, "a")], "id int, a string")
    new = spark.createDataFrame([(1,)], "id int")
    out = append_nodes(old, new)
    assert rows(out) == [(1, "a"), (1, None)]
    assert rows(unique_violations(out, "id")) == [(1, 2)]


def test_merge_keyed_and_by_pair(dup):
    empty = dup.where(F.lit(False))
    keyed = merge_rels(empty, dup, KEYED, ["rating"])
    assert rows(keyed, *KEYED, "rating") == [(1, 10, 100, 5.0), (1, 10, 101, 2.0)]
    pairs = merge_rels(empty, dup, PAIR, ["timestamp", "rating"])
    assert rows(pairs, *PAIR, "timestamp", "rating") == [(1, 10, 101, 2.0)]
    assert rows(merge_rels(pairs, dup, PAIR, ["timestamp", "rating"])) == rows(pairs)


def test_merge_without_set_columns_creates_each_pair_once(dup):
    pairs = dup.select(*PAIR)
    once = merge_rels(pairs.where(F.lit(False)), pairs, PAIR)
    assert rows(once) == [(1, 10)]
    assert rows(merge_rels(once, pairs, PAIR)) == [(1, 10)]


def test_append_is_not_idempotent(dup):
    out = append_rels(dup.where(F.lit(False)), dup)
    assert len(rows(out)) == 3
    assert len(rows(append_rels(out, dup))) == 6


def test_match_drops_rows_without_ends_and_with_null_ends(spark, edges):
    incoming = edges((1, 10, 1.0, 1), (9, 10, 1.0, 2), (1, 99, 1.0, 3), (None, 10, 1.0, 4), (1, None, 1.0, 5))
    src = (spark.createDataFrame([(1,), (2,), (None,)], "id int"), {"source_id": "id"})
    dst = (spark.createDataFrame([(10,), (None,)], "id int"), {"target_id": "id"})
    empty = incoming.where(F.lit(False))
    assert rows(append_rels(empty, incoming, src, dst)) == [(1, 10, 1.0, 1)]
    assert rows(merge_rels(empty, incoming, KEYED, ["rating"], src, dst), *KEYED) == [(1, 10, 1)]
    assert len(rows(append_rels(empty, incoming, src))) == 3


def test_match_gives_one_row_per_node_on_append_but_one_relationship_on_merge(spark, edges):
    incoming = edges((1, 10, 1.0, 1))
    twice = (spark.createDataFrame([(1,), (1,)], "id int"), {"source_id": "id"})
    empty = incoming.where(F.lit(False))
    assert len(rows(append_rels(empty, incoming, twice))) == 2
    assert len(rows(merge_rels(empty, incoming, KEYED, ["rating"], twice))) == 1


def rating_graph(spark, rels):
    source = spark.createDataFrame([(1, "one")], "source_id int, note string")
    target = spark.createDataFrame([(10,)], "target_id int")
    ends = End("Source", {"source_id": "source_id"}), End("Target", {"target_id": "target_id"})
    return PropertyGraph(
        {"Source": Nodes(source, ("source_id",)), "Target": Nodes(target, ("target_id",))},
        {"RELATES_TO": Rels(rels, *ends)},
    )


def test_upsert_rels_creates_missing_ends(spark, edges):
    incoming = edges((9, 10, 1.0, 1), (1, 11, 2.0, 2), (None, 10, 1.0, 3))
    graph = rating_graph(spark, incoming.where(F.lit(False)))
    only_ends = upsert_endpoints(graph, "RELATES_TO", incoming)
    assert rows(only_ends.nodes["Source"].df) == [(1, "one"), (9, None)]
    assert rows(only_ends.nodes["Target"].df) == [(10,), (11,)]
    out = upsert_rels(graph, "RELATES_TO", incoming)
    assert rows(out.nodes["Source"].df) == [(1, "one"), (9, None)]
    assert rows(out.rels["RELATES_TO"].df) == [(1, 11, 2.0, 2), (9, 10, 1.0, 1)]


def test_upsert_agrees_with_a_dict_on_random_input(spark):
    rng = random.Random(7)
    old = {k: rng.choice([None, rng.random()]) for k in range(0, 400, 2)}
    new = [(rng.randrange(500), rng.choice([None, rng.random()])) for _ in range(600)]
    want = dict(old)
    best = {}
    for k, v in new:
        if k not in best or best[k] is None or (v is not None and v > best[k]):
            best[k] = v
    want.update(best)
    out = upsert_nodes(
        spark.createDataFrame(list(old.items()), "k int, v double"), spark.createDataFrame(new, "k int, v double"), ["k"]
    )
    assert {r["k"]: r["v"] for r in out.collect()} == want
    assert out.count() == len(want)


KEYS = [
    ("int", "bigint", [1, 2, 3, None]),
    ("float", "double", [0.0, 1.5, 2.25, None]),
    ("decimal(10,0)", "decimal(12,2)", [1, 2, 3, None]),
    ("date", "timestamp_ntz", ["2020-01-01", "2020-01-02", None]),
    ("string COLLATE UTF8_LCASE", "string COLLATE UTF8_LCASE", ["a", "B", None]),
    ("int", "string", ["1", "2", None]),
]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize(("left", "right", "values"), KEYS)
def test_hub_join_equals_the_plain_join(spark, conf, how, left, right, values):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    raw = spark.createDataFrame([(None if v is None else str(v), i) for v in values for i in range(10)], "v string, i int")
    one = raw.select(F.col("v").cast(left).alias("k"), "i", F.lit(1).alias("_split"))
    other = raw.where("i < 2").select(F.upper("v").cast(right).alias("k"), F.col("i").alias("j"))
    plain = one.join(other, one.k == other.k, how)
    plain = plain.drop(other.k) if how in ("inner", "left") else plain
    joined = hub_join(one, other, ["k"], how)
    assert joined.columns == plain.columns
    key = lambda r: tuple(map(str, r))
    assert sorted(joined.collect(), key=key) == sorted(plain.collect(), key=key)


def test_hub_join_needs_a_common_type(spark):
    one, other = spark.range(3).selectExpr("array(id) AS k"), spark.range(3).selectExpr("id AS k")
    with pytest.raises(TypeError, match="no common type"):
        hub_join(one, other, ["k"], "inner")


def test_a_load_that_is_repeated_adds_nothing(spark):
    nodes = spark.createDataFrame([(1,), (2,)], "id int")
    batch = spark.createDataFrame([(1, 2, None), (1, 2, None), (2, 1, 0.5), (2, 9, 0.5)], "s int, t int, w double")
    ends = (nodes, {"s": "id"}), (nodes, {"t": "id"})
    nothing = batch.limit(0)
    once = stage(append_rels(nothing, batch, *ends, load="a"), "once")
    assert once.count() == 3 and once.select("rel_id").distinct().count() == 3
    assert rows(append_rels(once, batch.repartition(5), *ends, load="a")) == rows(once)
    # a part that got in before; another load with the same rows
    part = once.limit(1)
    assert rows(append_rels(part, batch, *ends, load="a")) == rows(once)
    assert with_rel_ids(nothing, "x").count() == 0
    both = append_rels(once, batch, *ends, load="b")
    assert both.count() == 6 and both.select("rel_id").distinct().count() == 6


def test_ids_that_are_there_leave_gaps_and_others_alone(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    batch = spark.createDataFrame([(1, 2)] * 150 + [(None, 3)] * 2, "s int, t int")
    once = stage(with_rel_ids(batch, "a"), "once")
    copy = F.substring_index("rel_id", "-", -1).cast("int")
    # gaps within and across words, an id twice, another load's that begins alike, what is no id of ours
    kept = once.where(~copy.isin(2, 60, 61, 120, 149))
    odd = [(1, 2, "a-b-" + "0" * 32 + "-1"), (1, 2, "a-x"), (1, 2, None), (1, 2, "b-1")]
    there = stage(kept.unionByName(kept.limit(3)).unionByName(spark.createDataFrame(odd, "s int, t int, rel_id string")), "there")
    found = append_rels(there, batch, load="a")
    assert rows(found) == rows(there.unionByName(once.where(copy.isin(2, 60, 61, 120, 149))))


def test_a_repeated_load_shuffles_no_ids(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    batch = stage(spark.createDataFrame([(1, 2), (1, 2), (2, 1)], "s int, t int"), "batch")
    once = stage(append_rels(batch.limit(0), batch, load="a"), "once")
    assert "hashpartitioning(rel_id" not in executed_plan(append_rels(once, batch, load="a"))
