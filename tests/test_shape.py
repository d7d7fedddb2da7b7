from __future__ import annotations

import random

from helpers import bag, executed_plan, rows
from pyspark.sql import functions as F

from propgraph import copies, extend_keys, group_edges, head, ingest_serially, node_set, rename, row_key
from propgraph.operators import shape
from propgraph.operators.write import one_per_key
from propgraph.staging import stage


def test_node_set_of_one_and_of_two_columns(edges):
    df = edges((1, 10, 5.0, 100), (1, 11, 3.0, 101), (2, 10, 4.0, 102))
    assert rows(node_set(df, "source_id", "id")) == [(1,), (2,)]
    assert rows(node_set(df, ["source_id", "target_id"], "id")) == [(1,), (10,), (11,), (2,)]


def test_node_set_drops_nulls(edges):
    df = edges((None, 10, 1.0, 1), (1, None, 1.0, 2))
    assert rows(node_set(df, ["source_id", "target_id"], "id")) == [(1,), (10,)]


def test_node_set_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "pairs")
    spark.range(50).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).write.parquet(path)
    df = node_set(spark.read.parquet(path), ["a", "b"], "n")
    assert df.count() == 51
    df.collect()
    assert executed_plan(df).count("FileScan") == 1


def test_rename_takes_dotted_columns(spark):
    df = spark.createDataFrame([(7, "A", 1)], "`source.key` int, `target.name` string, other int")
    out = rename(df, {"source.key": "source_key", "target.name": "target_name"})
    assert out.columns == ["source_key", "target_name"]
    assert rows(out) == [(7, "A")]


def test_copies_and_head(edges):
    df = edges((2, 10, 4.0, 102), (1, 10, 5.0, 100))
    assert len(rows(copies(df, 3))) == 6
    assert set(rows(copies(df, 3))) == set(rows(df))
    assert rows(head(df, ["source_id"], 1)) == [(1, 10, 5.0, 100)]


def test_row_key_is_dense_and_follows_the_order(spark):
    rng = random.Random(1)
    data = [(rng.randrange(9), i) for i in range(2000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "a int, b int").repartition(5)
    want = sorted((i, a, b) for i, (a, b) in enumerate(sorted(data)))
    for buckets in (1, 3, 16):
        assert sorted(map(tuple, row_key(df, ["a", "b"], buckets=buckets).collect())) == want


def test_row_key_agrees_between_reads_even_where_the_order_has_ties(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(300)], "a int, b int")
    keyed = row_key(df, ["a"])
    first = {r["b"]: r["key"] for r in keyed.collect()}
    again = {r["b"]: r["key"] for r in keyed.orderBy(F.rand()).collect()}
    assert first == again
    assert sorted(first.values()) == list(range(300))


def test_row_key_of_nothing_and_of_chosen_columns(spark):
    empty = spark.createDataFrame([], "a int")
    assert row_key(empty, ["a"]).collect() == []
    df = spark.createDataFrame([(3, "x"), (1, "y")], "a int, b string")
    assert row_key(df, ["a"], name="k", keep=["b"]).columns == ["k", "b"]
    assert rows(row_key(df, ["a"], name="k", keep=[])) == [(0,), (1,)]


def test_row_key_has_no_single_task_window(spark):
    df = shape.row_key(spark.range(100).toDF("a"), ["a"])
    df.collect()
    assert "Window" not in executed_plan(df)


def test_extended_keys_never_change(spark, conf):
    first = spark.createDataFrame([(2, "b"), (None, "z"), (1, "a")], "x int, y string")
    keyed = stage(row_key(first, ["x", "y"]), "keyed")
    assert rows(keyed, "key", "x") == sorted([(0, None), (1, 1), (2, 2)], key=repr)
    # rows that are there, null among them; repeated new ones; another column
    more = spark.createDataFrame([(0, "c", 7), (2, "b", 7), (None, "z", 7), (0, "c", 7), (2, "c", 8)], "x int, y string, v int")
    for partitions in (1, 6):
        conf("spark.sql.shuffle.partitions", partitions)
        twice = stage(extend_keys(keyed, more, ["x", "y"]), "extended")
        want = [(0, None, "z", None), (1, 1, "a", None), (2, 2, "b", None), (3, 0, "c", 7), (4, 2, "c", 8)]
        assert rows(twice, "key", "x", "y", "v") == bag(want)
        assert rows(extend_keys(twice, more, ["x", "y"]), *twice.columns) == rows(twice)
    assert rows(extend_keys(keyed.limit(0), first, ["x", "y"])) == rows(keyed)


def test_extending_keys_shuffles_the_rows_once(spark, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    more = stage(spark.range(50).selectExpr("id AS x", "id % 7 AS y", "string(id) AS v"), "more")
    keyed = row_key(more.where("x % 2 = 0"), ["x", "y"])
    plans = []

    def staged(df, name):
        plans.append(executed_plan(df))
        return stage(df, name)

    monkeypatch.setattr(shape, "stage", staged)
    found = extend_keys(keyed, more, ["x", "y"])
    assert len(plans) == 1 and plans[0].count("rangepartitioning") == 1 and "hashpartitioning" not in plans[0]
    assert sorted(r.key for r in found.collect()) == [*range(50)]


def test_columns_of_the_user_survive(spark):
    df = spark.createDataFrame([(5, 6, 7, 8), (6, 5, 8, 7)], "_copy int, _bucket int, _slot int, _start int")
    assert rows(copies(df, 2)) == bag([(5, 6, 7, 8)] * 2 + [(6, 5, 8, 7)] * 2)
    assert rows(row_key(df, ["_bucket"])) == [(0, 6, 5, 8, 7), (1, 5, 6, 7, 8)]
    edges = spark.createDataFrame([(1, 10, 3, 4, 5), (1, 11, 3, 4, 5)], "s int, t int, _degree int, _rank int, _slice int")
    assert group_edges(edges, "s", "t", 2, balanced=True).select("_degree", "_rank").distinct().collect() == [(3, 4)]
    seen = []
    ingest_serially(edges, lambda part, i: seen.extend(part.collect()), 2)
    assert sorted(r["t"] for r in seen) == [10, 11] and {r["_slice"] for r in seen} == {5}
    best = one_per_key(spark.createDataFrame([(1, "x", "p"), (1, "y", "q")], "k int, _best string, b string"), ["k"])
    assert rows(best) == [(1, "y", "q")]
