"""Stored graphs changed by small steps give what the same changes of frames give."""

from __future__ import annotations

import os
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from propgraph import (
    End,
    Nodes,
    PropertyGraph,
    Rels,
    append_nodes,
    append_rels,
    append_stored_nodes,
    append_stored_rels,
    ConstraintError,
    compact,
    create_store,
    declare,
    delete_nodes,
    delete_rels,
    delete_stored_nodes,
    delete_stored_rels,
    merge_rels,
    merge_stored_rels,
    open_store,
    upsert_nodes,
    upsert_rels,
    upsert_stored_nodes,
    upsert_stored_rels,
)
from propgraph.operators import stored
from propgraph.sources.buckets import BUCKET, LOAD, Store
from propgraph.sources.filters import build, maybe_there, words_for
from propgraph.staging import stage

EDGES = "source_id long, target_id long, at int, rating double"
ENDS = End("Source", {"source_id": "id"}), End("Target", {"target_id": "id"})


def graph(spark, seed=1, n=300):
    draw = random.Random(seed)
    edges = {(draw.randrange(1, 40), draw.randrange(1, 30), draw.randrange(4)): draw.random() for _ in range(n)}
    edges |= {(7, t, 9): 0.5 for t in range(1, 30)}  # a hub
    sources = spark.createDataFrame([(i, f"s{i}", float(i % 5)) for i in range(1, 40)], "id long, name string, score double")
    targets = spark.createDataFrame([(i,) for i in range(1, 30)], "id long")
    rels = spark.createDataFrame([(*k, v) for k, v in edges.items()], EDGES)
    return PropertyGraph(
        {"Source": Nodes(sources, ("id",)), "Target": Nodes(targets, ("id",))},
        {"RATED": Rels(rels, *ENDS, ("source_id", "target_id", "at"))},
    )


def content(g):
    frames = {n: x.df for n, x in g.nodes.items()} | {t: r.df for t, r in g.rels.items()}
    return {n: rows(df, *sorted(df.columns)) for n, df in frames.items()}


def same(store, g):
    assert content(store.graph()) == content(g)
    again = open_store(store.spark, store.path)
    assert again.version == store.version
    assert content(again.graph()) == content(g)


@pytest.fixture
def both(spark, tmp_path):
    g = graph(spark)
    return create_store(g, str(tmp_path / "store"), buckets=8), g


def folders(store, name):
    root = f"{store.path}/{name}"
    return {v: sorted(os.listdir(f"{root}/{v}")) for v in os.listdir(root)}


def test_a_new_store_holds_the_graph(both):
    store, g = both
    same(store, g)
    assert all(t.unique for t in store.tables.values())
    with pytest.raises(FileExistsError):
        create_store(g, store.path)


def test_upsert_writes_the_touched_buckets_only(spark, both):
    store, g = both
    batch = spark.createDataFrame([(3, 9.0), (100, 8.0), (None, 1.0), (3, 7.0)], "id int, score double")
    after = upsert_stored_nodes(store, "Source", batch)
    nodes = g.nodes["Source"]
    same(after, g.with_nodes("Source", Nodes(upsert_nodes(nodes.df, batch, ["id"]), ("id",))))
    table = store.nodes("Source")
    touched = {r[0] for r in spark.range(2).selectExpr("if(id = 0, 3L, 100L) id").select(table.bucket()).collect()}
    written = {b for b in folders(after, "nodes/Source")[f"{LOAD}=1"] if b.startswith(BUCKET)}
    assert written == {f"{BUCKET}={b}" for b in touched}
    kept = [loads for b, loads in enumerate(after.nodes("Source").loads) if b not in touched]
    assert all(loads in ((0,), ()) for loads in kept)
    assert after.rels("RATED") == store.rels("RATED")
    # the version before is still there
    assert content(open_store(spark, store.path, 0).graph()) == content(g)


def test_upsert_does_not_shuffle_the_stored_rows(spark, both):
    store, _ = both
    batch = spark.createDataFrame([(3, 9.0)], "id long, score double")
    winners = stage(stored._fitted(store.nodes("Source"), batch)[1], "winners")
    touched = stored._buckets(winners)
    laid = stored.lay_over(store.read(store.nodes("Source"), touched).drop(LOAD), winners, [BUCKET, "id"])
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_new_column_and_a_wrong_type(spark, both):
    store, g = both
    batch = spark.createDataFrame([(1, "x"), (200, "y")], "id long, colour string")
    after = upsert_stored_nodes(store, "Source", batch)
    same(after, g.with_nodes("Source", Nodes(upsert_nodes(g.nodes["Source"].df, batch, ["id"]), ("id",))))
    with pytest.raises(Exception, match="CAST"):
        upsert_stored_nodes(after, "Source", spark.createDataFrame([("z", "x")], "id string, colour string"))
    assert open_store(spark, store.path).version == 1


@pytest.mark.parametrize("match", [True, False])
def test_merge(spark, both, match):
    store, g = both
    batch = spark.createDataFrame([(7, 1, 9, 5.0), (7, 1, 9, 4.0), (7, 99, 9, 1.0), (1, 1, 77, 2.0), (None, 1, 1, 1.0)], EDGES)
    rels = g.rels["RATED"]
    src, dst = ((g.nodes["Source"].df, {"source_id": "id"}), (g.nodes["Target"].df, {"target_id": "id"})) if match else (None, None)
    merged = merge_rels(rels.df, batch, rels.identity, ["rating"], src, dst)
    after = merge_stored_rels(store, "RATED", batch, ["rating"], match)
    same(after, g.with_rels("RATED", rels.with_df(merged)))
    # a second time changes nothing; merging keys alone writes nothing that is there
    for set_cols in (["rating"], []):
        after = merge_stored_rels(after, "RATED", batch, set_cols, match)
        same(after, g.with_rels("RATED", rels.with_df(merged)))


def test_upsert_with_ends(spark, both):
    store, g = both
    batch = spark.createDataFrame([(7, 1, 9, 5.0), (500, 501, 1, 2.0), (502, None, 1, 3.0)], EDGES)
    after, want = upsert_stored_rels(store, "RATED", batch), upsert_rels(g, "RATED", batch)
    same(after, want)
    assert after.version == store.version + 1
    more = graph(spark, seed=5).rels["RATED"].df
    same(upsert_stored_rels(after, "RATED", more), upsert_rels(want, "RATED", more))


def test_append(spark, both):
    store, g = both
    batch = spark.createDataFrame([(7, 1, 9, 5.0), (7, 1, 9, 5.0), (7, 99, 9, 1.0), (7, None, 9, 1.0)], EDGES)
    rels, ends = g.rels["RATED"], [(g.nodes[e.label].df, e.cols) for e in ENDS]
    after = append_stored_rels(store, "RATED", batch)
    want = g.with_rels("RATED", rels.with_df(append_rels(rels.df, batch, *ends)))
    same(after, want)
    assert not after.rels("RATED").unique
    names = spark.createDataFrame([(None, "n"), (1, "again")], "id long, name string")
    after = append_stored_nodes(after, "Source", names)
    want = want.with_nodes("Source", Nodes(append_nodes(g.nodes["Source"].df, names), ("id",)))
    same(after, want)
    # of rows with one key a delete takes those alone for which the condition holds
    after = delete_stored_rels(after, "RATED", F.col("rating") == 5.0)
    same(after, delete_rels(want, "RATED", F.col("rating") == 5.0))
    same(compact(after), delete_rels(want, "RATED", F.col("rating") == 5.0))


def test_deletes_before_and_after_compaction(spark, both):
    store, g = both
    where = F.col("rating") < 0.3
    after, want = delete_stored_rels(store, "RATED", where), delete_rels(g, "RATED", where)
    same(after, want)
    with pytest.raises(ValueError, match="still have"):
        delete_stored_nodes(after, "Source", F.col("id") == 7)
    gone = F.col("score") == 2.0
    after, want = delete_stored_nodes(after, "Source", gone, detach=True), delete_nodes(want, "Source", gone, detach=True)
    same(after, want)
    assert not [v for v in folders(after, "rels/RATED") if v != f"{LOAD}=0"]  # nothing was rewritten
    # what comes back after a delete is not hidden by it
    batch = spark.createDataFrame([(7, 1, 9, 5.0), (2, 2, 2, 6.0)], EDGES)
    after, want = upsert_stored_rels(after, "RATED", batch), upsert_rels(want, "RATED", batch)
    same(after, want)
    folded = compact(after)
    same(folded, want)
    assert not any(t.tombs for t in folded.tables.values())
    assert compact(folded).version == folded.version
    same(delete_stored_nodes(folded, detach=True), delete_nodes(want, detach=True))


def test_plain_delete_of_all(spark, both):
    store, g = both
    with pytest.raises(ValueError, match="still have"):
        delete_stored_nodes(store)
    bare = delete_stored_rels(store)
    same(delete_stored_nodes(bare, "Source", F.col("id") > 5), delete_nodes(delete_rels(g), "Source", F.col("id") > 5))


def test_compaction_finds_own_tombs_by_their_buckets(spark, both, monkeypatch):
    store, _ = both
    after = delete_stored_rels(store, "RATED", F.col("rating") > 0.99)
    hidden = Store.hidden

    def not_joined(self, rows, table, how="left_anti"):
        assert how == "left_anti", "the rows are joined with their own tombs"
        return hidden(self, rows, table, how)

    monkeypatch.setattr(Store, "hidden", not_joined)
    folded = compact(after)
    assert content(folded.graph()) == content(after.graph()) and not folded.rels("RATED").tombs
    before, now = after.rels("RATED").loads, folded.rels("RATED").loads
    buckets = {r[0] for r in hidden(after, after.raw(after.rels("RATED")), after.rels("RATED"), "left_semi").select(BUCKET).collect()}
    assert buckets and {b for b in range(len(now)) if now[b] != before[b]} == buckets


def test_a_change_that_fails_is_not_seen(spark, both):
    store, g = both
    failing = spark.createDataFrame([(1, "x")], "id long, name string").select("id", F.raise_error("stop").cast("string").alias("name"))
    with pytest.raises(Exception, match="stop"):
        append_stored_nodes(store, "Source", failing)
    same(open_store(spark, store.path), g)
    batch = spark.createDataFrame([(1, "y")], "id long, name string")
    same(upsert_stored_nodes(store, "Source", batch), g.with_nodes("Source", Nodes(upsert_nodes(g.nodes["Source"].df, batch, ["id"]), ("id",))))
    # another writer was first: nothing of theirs is touched
    with pytest.raises(FileExistsError):
        upsert_stored_nodes(store, "Source", batch.limit(0))
    assert (1, "y") in rows(open_store(spark, store.path).graph().nodes["Source"].df, "id", "name")


def test_names_that_the_store_needs(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], f"id long, {BUCKET} int")
    with pytest.raises(ValueError, match=BUCKET):
        create_store(PropertyGraph({"A": Nodes(df, ("id",))}), str(tmp_path / "s"))


def test_a_repeated_append_adds_nothing(spark, both):
    store, g = both
    batch = spark.createDataFrame([(7, 1, 9, 5.0), (7, 1, 9, 5.0), (7, 99, 9, 1.0), (3, 3, 9, 1.0)], EDGES)
    once = append_stored_rels(store, "RATED", batch, load="l1")
    assert once.graph().rels["RATED"].df.count() == g.rels["RATED"].df.count() + 3
    assert content(append_stored_rels(once, "RATED", batch, load="l1").graph()) == content(once.graph())


@pytest.fixture
def guarded(both):
    store, g = both
    return declare(declare(store, "Source", "name", "unique"), "Source", "id", "key"), g


def refused(store, change, match):
    before = content(open_store(store.spark, store.path).graph())
    with pytest.raises(ConstraintError, match=match):
        change()
    assert content(open_store(store.spark, store.path).graph()) == before


def named(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, name string")


def test_a_batch_that_breaks_a_constraint_is_refused(spark, guarded):
    store, g = guarded
    for batch, match in [
        (named(spark, (100, "s7")), "name is there already: s7"),
        (named(spark, (100, "new"), (101, "new")), "name repeats"),
        (named(spark, (100, "new"), (100, "newer")), "id repeats"),
        (named(spark, (7, "new")), "id is there already: 7"),
        (named(spark, (None, "new")), "without Source.id"),
    ]:
        refused(store, lambda b=batch: append_stored_nodes(store, "Source", b), match)
    fine = named(spark, (100, "new"), (101, None), (102, None))
    after = append_stored_nodes(store, "Source", fine)
    same(after, g.with_nodes("Source", Nodes(append_nodes(g.nodes["Source"].df, fine), ("id",))))
    # the filters know what was added
    refused(after, lambda: append_stored_nodes(after, "Source", named(spark, (103, "new"))), "there already: new")


def test_upserts_obey_too(spark, guarded):
    store, g = guarded
    refused(store, lambda: upsert_stored_nodes(store, "Source", named(spark, (100, "s7"))), "there already: s7")
    refused(store, lambda: upsert_stored_nodes(store, "Source", named(spark, (1, "x"), (2, "x"))), "repeats")
    # two nodes change their names with each other; one keeps its own
    batch = named(spark, (1, "s2"), (2, "s1"), (3, "s3"), (100, "s100"))
    after = upsert_stored_nodes(store, "Source", batch)
    same(after, g.with_nodes("Source", Nodes(upsert_nodes(g.nodes["Source"].df, batch, ["id"]), ("id",))))
    # a name that was given up or deleted is free again
    after = upsert_stored_nodes(after, "Source", named(spark, (100, "other")))
    after = upsert_stored_nodes(after, "Source", named(spark, (101, "s100")))
    after = delete_stored_nodes(after, "Source", F.col("id") == 101, detach=True)
    after = append_stored_nodes(after, "Source", named(spark, (102, "s100")))
    folded = compact(after)
    assert len(folded.nodes("Source").filters) == 2 and content(folded.graph()) == content(after.graph())
    refused(folded, lambda: append_stored_nodes(folded, "Source", named(spark, (103, "s100"))), "there already: s100")
    # ends that are created have a key but no name
    batch = spark.createDataFrame([(500, 1, 1, 2.0)], EDGES)
    named_all = declare(compact(folded), "Source", "name", "key")
    refused(named_all, lambda: upsert_stored_rels(named_all, "RATED", batch), "without Source.name")
    assert upsert_stored_rels(named_all, "RATED", batch.selectExpr("1L source_id", "target_id", "at", "rating")).version


def test_declaring_what_does_not_hold(spark, guarded):
    store, _ = guarded
    with pytest.raises(ConstraintError, match="score is not unique"):
        declare(store, "Source", "score", "unique")
    with pytest.raises(ValueError, match="kind"):
        declare(store, "Source", "name", "index")


def test_filters_rule_out_nearly_all_others_and_none_of_their_own(spark):
    there, others = spark.range(20_000).withColumnRenamed("id", "v"), spark.range(20_000, 40_000).withColumnRenamed("id", "v")
    filters = [(filters_of(there.where(f"v % 2 = {i}")), words_for(10_000)) for i in (0, 1)]
    assert maybe_there(there, "v", filters).count() == 20_000
    assert maybe_there(others, "v", filters).count() < 2_000


def filters_of(df):
    return build(df, "v", words_for(df.count()))
