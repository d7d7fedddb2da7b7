"""Batches of bipartite edges that can be written in parallel without conflicts.

Source and target nodes are put into ``n`` groups each, which cuts the edges into
n x n blocks. Batch b holds the blocks whose target group is b places after the
source group, so inside a batch no node occurs in two blocks (interchangeable
blocks as in Gemulla et al., KDD 2011).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from propgraph.functions.columns import batch_of, hash_group, snake_group
from propgraph.operators.joins import common_types, fresh, hub_join
from propgraph.operators.shape import row_key
from propgraph.operators.write import Match, lay_over_all, match_ends, one_per_key
from propgraph.sources import files
from propgraph.staging import discard, stage, staging


def _dealt(edges: DataFrame, col: str, n: int, group: str) -> DataFrame:
    """Node -> group: nodes by falling degree, then key, dealt in snake order."""
    degree, rank = fresh("_degree", edges), fresh("_rank", edges)
    degrees = edges.where(F.col(col).isNotNull()).groupBy(col).agg((-F.count("*")).alias(degree))
    ranked = row_key(degrees, [degree, col], name=rank, keep=[col])
    return ranked.select(col, snake_group(F.col(rank), n).alias(group))


def group_edges(df: DataFrame, src: str, dst: str, n: int, balanced: bool = False) -> DataFrame:
    """Add int columns ``source_group`` and ``target_group``, both 0..n-1.

    By default a group is a hash of the node key: no shuffle at all. ``balanced``
    evens out the blocks by node degree, at the price of two shuffles of the edges;
    it reads ``df`` three times and runs jobs, so stage a costly input first. A null
    node gets a null group.
    """
    if not balanced:
        return df.withColumns({"source_group": hash_group(src, n), "target_group": hash_group(dst, n)})
    columns = df.columns
    for col, group in ((src, "source_group"), (dst, "target_group")):
        df = hub_join(df, _dealt(df, col, n, group), [col], "left")
    return df.select(*columns, "source_group", "target_group")


@dataclass(frozen=True)
class Batched:
    """Edges with ``source_group``, ``target_group`` and ``batch``, all of them 0..n-1 or null."""

    df: DataFrame
    n: int


def batch_edges(df: DataFrame, src: str, dst: str, n: int, balanced: bool = False) -> Batched:
    """Group the edges (see ``group_edges``) and add int column ``batch``; the result carries ``n``."""
    grouped = group_edges(df, src, dst, n, balanced)
    return Batched(grouped.withColumn("batch", batch_of("source_group", "target_group", n)), n)


def batch_heatmap(batched: Batched) -> DataFrame:
    """Relationships per block. The largest block bounds how well a batch can spread.

    A node lies in one group, but its edges spread over all batches, so a hub with a
    share s of the edges fills about s/n of them into each of its blocks.
    """
    return batched.df.groupBy("batch", "source_group", "target_group").agg(F.count("*").alias("rel_count"))


def _checked(batched: Batched) -> DataFrame:
    """The edges; a task that meets a group or batch out of range fails."""
    names = ("source_group", "target_group", "batch")
    fits = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).between(0, batched.n - 1), F.lit(True)) for c in names])
    place = F.concat_ws(", ", *[F.concat(F.lit(f"{c} "), F.col(c)) for c in names])
    failed = F.raise_error(F.concat(F.lit(f"not within {batched.n} groups: "), place))
    return batched.df.withColumn("batch", F.when(fits, F.col("batch")).otherwise(failed.cast("int")))


def ingest_in_batches(batched: Batched, write_fn: Callable[[DataFrame, int], None], ledger: str | None = None) -> None:
    """Call ``write_fn(part, b)`` for each batch b in turn; a part has one partition per group.

    The batched edges are written once, partitioned by batch, so each batch reads
    only its own files; the copy is deleted at the end. The rebalance evens out the file
    sizes and splits a large batch. Rows with a null node match nothing and are left out;
    a group or batch out of range is an error.

    ``ledger`` is a folder that makes the load resumable. The copy is kept there, and a marker is
    written after each batch. A call with the ledger of one that was broken off goes on
    with the copy of that call, whatever ``batched`` holds by then, and skips the marked
    batches; after the last one a call does nothing.

    Spark may run a task again, and a batch may have been broken off before its marker, so
    ``write_fn`` should be idempotent: write to a path of its own per batch, or merge instead
    of append.
    """

    def by_group(part: DataFrame, b: int) -> None:
        write_fn(part.repartitionById(batched.n, F.col("source_group")), b)

    _each_batch(batched, by_group, ledger)


def _each_batch(batched: Batched, write_fn: Callable[[DataFrame, int], None], ledger: str | None) -> None:
    """Stage the edges by batch and call ``write_fn`` with what each batch's files hold."""
    df, n = batched.df, batched.n
    spark = df.sparkSession
    spread = _checked(batched).where(F.col("batch").isNotNull()).hint("rebalance", F.col("batch"))

    def run(staged: DataFrame, b: int) -> None:
        write_fn(staged.select(*df.columns).where(F.col("batch") == b), b)

    if ledger is None:
        with staging(spark):
            staged = stage(spread, "batches", ["batch"])
            for b in range(n):
                run(staged, b)
        return
    ledger = ledger.rstrip("/")
    rest = sorted(set(range(n)) - _marked(spark, ledger, batched))
    if rest:
        copy = f"{ledger}/input"
        if "input.json" not in files.names(spark, ledger):
            spread.write.mode("overwrite").partitionBy("batch").parquet(copy)
            files.write_text(spark, f"{ledger}/input.json", _about(batched))
        staged = spark.read.schema(df.schema).parquet(copy)
        for b in rest:
            run(staged, b)
            files.write_text(spark, f"{ledger}/done/{b}", "")
        discard(spark, copy)


def _about(batched: Batched) -> str:
    return json.dumps({"n": batched.n, "schema": batched.df.schema.jsonValue()})


def _marked(spark: SparkSession, ledger: str, batched: Batched) -> set[int]:
    """The batches that are done; an error if the ledger is that of another load."""
    if "input.json" in files.names(spark, ledger):
        about = json.loads(files.read_text(spark, f"{ledger}/input.json"))
        if about["n"] != batched.n or _columns(about["schema"]) != _columns(batched.df.schema.jsonValue()):
            raise ValueError(f"{ledger} belongs to a load with other columns or another number of batches")
    return {int(name) for name in files.names(spark, f"{ledger}/done") if name.isdigit()}


def _columns(schema: dict) -> list[tuple]:
    return [(f["name"], json.dumps(f["type"])) for f in schema["fields"]]


def append_in_batches(
    incoming: Batched, path: str, src: Match | None = None, dst: Match | None = None, ledger: str | None = None
) -> DataFrame:
    """Create the relationships of ``incoming`` batch by batch below ``path``, which must be new.

    As ``append_rels`` onto nothing. The ends are matched once, before the edges are
    dealt into batches, so no batch reads the nodes again. With the ``ledger`` of a call that
    was broken off (see ``ingest_in_batches``) ``path`` is the same as then.
    """
    matched = match_ends(incoming.df, src, dst)

    def write_batch(part: DataFrame, b: int) -> None:
        part.drop("batch").write.mode("overwrite").parquet(f"{path}/batch={b}")

    ingest_in_batches(replace(incoming, df=matched), write_batch, ledger)
    return _written(matched, path)


def merge_in_batches(
    existing: DataFrame,
    incoming: Batched,
    src: str,
    dst: str,
    identity: Sequence[str],
    set_cols: Sequence[str],
    path: str,
    src_nodes: Match | None = None,
    dst_nodes: Match | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """Merge ``incoming`` into ``existing`` batch by batch below ``path``, which must be new.

    As ``merge_rels``, onto a frame that has all columns; these keep the types they have there.
    ``identity`` holds both ends, so all rows of one identity lie in one batch. The ends are
    matched and the greatest row of each identity is found once, before the batches. Then
    both sides are dealt by a hash of their ends in the type that holds those of both,
    however ``incoming`` was grouped, and a batch is one join of its two parts.
    """
    spark, n = existing.sparkSession, incoming.n
    wanted = incoming.df.select(*dict.fromkeys([*identity, *set_cols]))
    winners = one_per_key(match_ends(wanted, src_nodes, dst_nodes, "left_semi"), identity, set_cols)
    kinds = common_types(existing, winners, [src, dst])
    groups = ("source_group", "target_group")
    if taken := {*groups, "batch"} & set(existing.columns):
        raise ValueError(f"the relationships have a column named {taken.pop()}")

    def dealt(df: DataFrame) -> DataFrame:
        hashed = {g: hash_group(F.col(c).cast(kind), n) for g, c, kind in zip(groups, (src, dst), kinds, strict=True)}
        return df.withColumns(hashed).withColumn("batch", batch_of(*groups, n))

    kept_types = [F.col(f.name).cast(f.dataType).alias(f.name) for f in existing.schema]
    known = dealt(existing).select(*existing.columns, F.coalesce("batch", F.lit(-1)).alias("batch"))
    with staging(spark):
        old = stage(known.hint("rebalance", F.col("batch")), "existing", ["batch"])

        def write_batch(part: DataFrame, b: int) -> None:
            own = old.where(F.col("batch") == b).drop("batch")
            merged = lay_over_all(own, part.drop("batch", *groups), identity)
            merged.select(*kept_types).write.mode("overwrite").parquet(f"{path}/batch={b}")

        _each_batch(Batched(dealt(winners), n), write_batch, ledger)
        # relationships with a null end match nothing and stay as they are
        old.where("batch = -1").drop("batch").write.mode("overwrite").parquet(f"{path}/batch=-1")
    return spark.read.schema(existing.schema).parquet(path).select(*existing.columns)


def _written(like: DataFrame, path: str) -> DataFrame:
    spark = like.sparkSession
    schema = StructType([f for f in like.schema if f.name != "batch"])
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def ingest_serially(df: DataFrame, write_fn: Callable[[DataFrame, int], None], slices: int | None = None) -> None:
    """Call ``write_fn(part, i)`` for one-partition parts in turn: one writer at a time.

    For an outside sink that takes no concurrent writes; files never need it. There
    are ``slices`` parts (default: one per core), so no task handles all rows. The cut
    is by row count, written with the rows: equal rows spread as well.
    """
    n = slices or df.sparkSession.sparkContext.defaultParallelism
    number = fresh("_slice", df)
    sliced = df.repartition(n).withColumn(number, F.spark_partition_id())
    with staging(df.sparkSession):
        staged = stage(sliced, "slices", [number])
        for i in range(n):
            # nothing but a file scan lies below the coalesce
            write_fn(staged.where(F.col(number) == i).select(*df.columns).coalesce(1), i)
