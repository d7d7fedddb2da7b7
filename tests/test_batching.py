from __future__ import annotations

import random
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from helpers import rows
from pyspark.sql import functions as F

from propgraph import (
    append_in_batches,
    append_rels,
    batch_edges,
    batch_heatmap,
    group_edges,
    ingest_in_batches,
    ingest_serially,
    merge_in_batches,
    merge_rels,
)
from propgraph.functions.columns import snake_group
from propgraph.operators import batching
from propgraph.staging import staging


@pytest.fixture
def random_edges(edges):
    rng = random.Random(3)
    return edges(*[(rng.randrange(60), rng.randrange(40), 1.0, i) for i in range(1500)])


@pytest.mark.parametrize("balanced", [False, True])
@pytest.mark.parametrize("n", [1, 5])
def test_groups_of_a_batch_share_no_node(random_edges, n, balanced):
    batched = batch_edges(random_edges, "source_id", "target_id", n, balanced)
    df = batched.df
    source, target = defaultdict(set), defaultdict(set)
    pairs = defaultdict(set)
    for r in df.collect():
        assert {r["source_group"], r["target_group"], r["batch"]} <= set(range(n))
        source[r["source_id"]].add(r["source_group"])
        target[r["target_id"]].add(r["target_group"])
        pairs[r["batch"]].add((r["source_group"], r["target_group"]))
    assert all(len(groups) == 1 for groups in [*source.values(), *target.values()])
    for found in pairs.values():
        assert len({s for s, _ in found}) == len({t for _, t in found}) == len(found)
    assert rows(df.select(*random_edges.columns)) == rows(random_edges)
    assert sum(r["rel_count"] for r in batch_heatmap(batched).collect()) == 1500


def test_snake_order(spark):
    dealt = spark.range(10).orderBy("id").select(snake_group(F.col("id"), 3)).collect()
    assert [r[0] for r in dealt] == [0, 1, 2, 2, 1, 0, 0, 1, 2, 2]


def test_balanced_blocks_even_out_a_hub(edges):
    hub = [(1, t, 1.0, t) for t in range(1000)] + [(s, s, 1.0, s) for s in range(2, 502)]
    n = 5
    batched = batch_edges(edges(*hub), "source_id", "target_id", n, balanced=True)
    df = batched.df
    sizes = [r["rel_count"] for r in batch_heatmap(batched).collect()]
    # the hub cannot be split between groups, but it meets all batches
    assert max(sizes) <= 1000 / n + 500 / n
    of_hub = Counter(r["batch"] for r in df.where("source_id = 1").collect())
    assert set(of_hub.values()) == {1000 // n}


@pytest.mark.parametrize("balanced", [False, True])
def test_null_ends_keep_their_row_but_are_not_ingested(edges, balanced):
    df = edges((1, 10, 1.0, 1), (None, 10, 1.0, 2), (1, None, 1.0, 3))
    out = batch_edges(df, "source_id", "target_id", 2, balanced)
    assert len(rows(out.df)) == 3
    assert len(rows(out.df.where("batch is null"))) == 2
    written = []
    ingest_in_batches(out, lambda part, b: written.extend(part.collect()))
    assert [r["timestamp"] for r in written] == [1]


def test_ingest_runs_batches_in_order_with_one_group_per_partition(random_edges):
    n = 4
    batched = batch_edges(random_edges, "source_id", "target_id", n)
    seen, order = [], []

    def write(part, b):
        assert part.rdd.getNumPartitions() == n
        order.append(b)
        placed = part.withColumn("_task", F.spark_partition_id()).collect()
        assert {(r["source_group"], r["_task"]) for r in placed} == {(r["source_group"],) * 2 for r in placed}
        assert {r["batch"] for r in placed} == {b}
        seen.extend(tuple(r)[:-1] for r in placed)

    ingest_in_batches(batched, write)
    assert order == list(range(n))
    assert sorted(seen) == sorted(tuple(r) for r in batched.df.collect())


@pytest.mark.parametrize("column", ["batch", "source_group", "target_group"])
@pytest.mark.parametrize("value", [-1, 4])
def test_a_group_or_batch_out_of_range_fails(random_edges, column, value):
    batched = batch_edges(random_edges, "source_id", "target_id", 4)
    off = F.when(F.col("timestamp") == 7, value).otherwise(F.col(column)).cast("int")
    with pytest.raises(Exception, match="not within 4 groups"):
        ingest_in_batches(replace(batched, df=batched.df.withColumn(column, off)), lambda part, b: part.collect())


def test_ingest_leaves_no_copy_behind(spark, random_edges, tmp_path):
    batched = batch_edges(random_edges, "source_id", "target_id", 2)

    def fail(part, b):
        assert list(tmp_path.iterdir())
        raise RuntimeError("sink")

    with staging(spark, str(tmp_path)):
        ingest_in_batches(batched, lambda part, b: part.count())
        ingest_serially(random_edges, lambda part, i: part.count(), 2)
        with pytest.raises(RuntimeError, match="sink"):
            ingest_in_batches(batched, fail)
    assert not list(tmp_path.iterdir())


def test_merge_in_batches_equals_the_merge_at_once(spark, random_edges, edges, tmp_path):
    identity, rng = ["source_id", "target_id", "timestamp"], random.Random(5)
    old = edges(*[(rng.randrange(60), rng.randrange(40), 9.0, i) for i in range(700, 900)], (None, 1, 9.0, 1))
    nodes = spark.range(50).withColumnRenamed("id", "k")
    ends = (nodes, {"source_id": "k"}), (nodes.where("k % 3 <> 0"), {"target_id": "k"})
    want = merge_rels(old, random_edges, identity, ["rating"], *ends)
    got = merge_in_batches(
        old, batch_edges(random_edges, "source_id", "target_id", 3), "source_id", "target_id", identity, ["rating"],
        str(tmp_path / "merged"), *ends,
    )
    assert rows(got) == rows(want)
    copied = random_edges.unionAll(random_edges)
    created = append_in_batches(batch_edges(copied, "source_id", "target_id", 3), str(tmp_path / "created"), *ends)
    assert rows(created.select(copied.columns)) == rows(append_rels(copied.limit(0), copied, *ends))


@pytest.mark.parametrize("slices", [1, 3, None])
def test_serial_ingest_writes_one_partition_at_a_time(random_edges, slices):
    seen = []

    def write(part, i):
        assert part.rdd.getNumPartitions() == 1
        seen.append(part.collect())

    ingest_serially(random_edges, write, slices)
    slices = slices or 8
    assert len(seen) == slices
    assert sorted(tuple(r) for part in seen for r in part) == sorted(tuple(r) for r in random_edges.collect())
    assert max(map(len, seen)) <= 1500 / slices + 10


def test_string_keys(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "s string, t string")
    out = group_edges(df, "s", "t", 7)
    assert out.where("source_group is null or target_group is null").isEmpty()


def distinct_edges(spark, n, ids="bigint"):
    rng = random.Random(11)
    pairs = rng.sample([(a, b) for a in range(40) for b in range(40)], n)
    df = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "s bigint, t bigint, w double")
    return df.withColumns({c: F.col(c).cast(ids) for c in ("s", "t")})


@pytest.mark.parametrize("balanced", [False, True])
@pytest.mark.parametrize("ids", ["bigint", "double", "int"])
def test_merge_in_batches_whatever_the_grouping_and_the_types(spark, tmp_path, balanced, ids):
    incoming = distinct_edges(spark, 400)
    old = distinct_edges(spark, 400, ids).where("s < 20").withColumn("w", F.lit(9.0))
    batched = batch_edges(incoming, "s", "t", 4, balanced)
    got = merge_in_batches(old, batched, "s", "t", ["s", "t"], ["w"], str(tmp_path / "merged"))
    assert got.dtypes == old.dtypes and got.count() == 400
    assert rows(got) == rows(merge_rels(old, incoming.withColumns({c: F.col(c).cast(ids) for c in ("s", "t")}), ["s", "t"], ["w"]))


class Broken(RuntimeError):
    pass


def broken_at(write, at):
    ran = []

    def run(part, b):
        if b == at:
            raise Broken
        ran.append(b)
        write(part, b)

    return run, ran


def test_a_load_goes_on_where_it_was_broken_off(spark, random_edges, tmp_path):
    batched = batch_edges(random_edges, "source_id", "target_id", 8)
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")

    def write(part, b):
        part.write.mode("overwrite").parquet(f"{out}/n={b}")

    first, ran = broken_at(write, 6)
    with pytest.raises(Broken):
        ingest_in_batches(batched, first, ledger)
    assert ran == [0, 1, 2, 3, 4, 5]
    # the input is that of the first call, even if its source has changed since
    again, ran = broken_at(write, None)
    ingest_in_batches(replace(batched, df=batched.df.where("rating < 0")), again, ledger)
    assert ran == [6, 7]
    assert rows(spark.read.parquet(out), *random_edges.columns) == rows(random_edges)
    ingest_in_batches(batched, again, ledger)
    assert ran == [6, 7] and not (tmp_path / "ledger" / "input").exists()
    with pytest.raises(ValueError, match="another"):
        ingest_in_batches(batch_edges(random_edges, "source_id", "target_id", 9), write, ledger)


def test_a_copy_that_was_broken_off_is_made_anew(spark, random_edges, tmp_path):
    batched = batch_edges(random_edges, "source_id", "target_id", 3)
    failing = F.when(F.col("timestamp") == 700, F.raise_error("stop").cast("float")).otherwise(F.col("rating"))
    with pytest.raises(Exception, match="stop"):
        ingest_in_batches(replace(batched, df=batched.df.withColumn("rating", failing)), lambda *_: None, str(tmp_path))
    seen = []
    ingest_in_batches(batched, lambda part, b: seen.append(part.count()), str(tmp_path))
    assert sum(seen) == random_edges.count()


def test_a_merge_and_an_append_go_on_as_well(spark, random_edges, tmp_path, monkeypatch):
    batched = batch_edges(random_edges, "source_id", "target_id", 3)
    identity = ["source_id", "target_id", "timestamp"]
    old = random_edges.where("source_id < 20").withColumn("rating", F.lit(9.0).cast("float"))
    want = merge_rels(old, random_edges, identity, ["rating"])
    mark, calls = batching.files.write_text, []

    def fails_once(spark, path, text):
        calls.append(path)
        if len(calls) == 3:  # the copy, one batch, then the marker of the second is lost
            raise Broken
        mark(spark, path, text)

    for name in ("merge", "append"):
        calls.clear()
        path, ledger = str(tmp_path / name), str(tmp_path / f"{name}-ledger")

        def load():
            if name == "merge":
                return merge_in_batches(old, batched, "source_id", "target_id", identity, ["rating"], path, ledger=ledger)
            return append_in_batches(batched, path, ledger=ledger)

        monkeypatch.setattr(batching.files, "write_text", fails_once)
        with pytest.raises(Broken):
            load()
        monkeypatch.setattr(batching.files, "write_text", mark)
        assert rows(load(), *old.columns) == rows(want if name == "merge" else random_edges, *old.columns)
